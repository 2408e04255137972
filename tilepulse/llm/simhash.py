"""SimHash near-duplicate groups by deletion-variant signatures (operator 5).

Fingerprints: words ``[^\\x20\\x09-\\x0D]+`` of the A-Z-lowered text, shingles of ``shingle``
words with repeats (fewer words: the whole sequence), XXH64 with seed 42; a bit is 1 if it is
set in over half the hashes; no words give zero.

Groups are the connected components of the links between fingerprints at ``max_bits`` or fewer
differing bits. Documents meet only through their distinct fingerprints, so a group of exact
copies is one entry of the index, however large.

Defined cases: null text counts as empty (fingerprint zero); a null id gets a fingerprint and
its group's smallest id, null if no member has one; repeated rows give repeated results; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, written
from .components import components

SEED = 42
#: Hashes whose bits are counted at once (64 bytes each).
COUNT_ROWS = 200_000
#: Entries of an index bucket up to which its pairs are joined; larger ones are cut further.
HOT_BUCKET = 128


def shingle_hashes(text: str, shingle: int) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [h(b" ".join(words), SEED)] if words else []
    return [h(b" ".join(x), SEED) for x in zip(*(words[i:] for i in range(shingle)), strict=False)]


def fingerprints(texts: list[str], shingle: int) -> np.ndarray:
    """uint64 fingerprint of each text. Hashes are counted in slices of bounded size, so a very
    long text and a batch of short ones take the same memory."""
    hashes: list[int] = []
    lens = []
    for t in texts:
        x = shingle_hashes(t, shingle)
        lens.append(len(x))
        hashes += x
    all_h = np.array(hashes, np.uint64)
    lens = np.array(lens, np.int64)
    doc = np.repeat(np.arange(len(texts)), lens)
    counts = np.zeros((len(texts), 64), np.int64)
    for at in range(0, len(all_h), COUNT_ROWS):
        part, own = all_h[at : at + COUNT_ROWS], doc[at : at + COUNT_ROWS]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        lead = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        counts[own[lead]] += np.add.reduceat(bits, lead, axis=0, dtype=np.int32)
    up = (2 * counts > lens[:, None]).astype(np.uint8)
    return np.packbits(up, axis=1).view(">u8").ravel().astype(np.uint64)


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp): one row per input row, fp the fingerprint as a signed long."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])
    return map_texts(docs, id_col, text_col, lambda ids, t: [ids, fingerprints(t, shingle).view(np.int64)], schema)


def signatures(fps: DataFrame) -> DataFrame:
    """The index (key, fp): each fingerprint cut into two segments of 32 bits. Two fingerprints
    at distance 2 or less have a segment that differs in at most one bit, so per segment there
    are 33 entries: the segment with bit i deleted for each i, and the exact segment (i = 32).
    The key holds the segment and i above what is left of the segment."""
    parts = F.array(F.expr("fp & 4294967295L"), F.expr("shiftrightunsigned(fp, 32)"))
    seg = fps.select("fp", F.posexplode(parts).alias("s", "part"))
    seg = seg.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(32))))
    rest = F.when(F.col("i") == 32, F.col("part")).otherwise(F.col("part").bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, i)"))))
    key = F.expr("shiftleft(cast(s * 33 + i as bigint), 32)").bitwiseOR(rest)
    return seg.select(key.alias("key"), "fp")


def _side() -> Column:
    """The deleted bit of an entry, -1 if its segment is exact. Of two entries of a bucket, those
    of opposite sides differ in that bit of the segment, those of one side not at all."""
    kind = F.expr("cast(shiftright(key, 32) as int)")
    bit = F.expr("cast(shiftrightunsigned(fp, cast(shiftright(key, 32) div 33 * 32 + shiftright(key, 32) % 33 as int)) & 1 as int)")
    return F.when(kind % 33 == 32, -1).otherwise(bit)


def _distance() -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b")))


def near_links(fps: DataFrame, max_bits: int = 2, hot: int = HOT_BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct fingerprints within
    ``max_bits`` (at most 2) differing bits.

    The index is shuffled by key once; entries alone in their bucket go. Buckets are joined by
    key, opposite sides only, and each pair verified. Buckets over ``hot`` entries give no
    pairs: there the other segment is deleted too (two bits of it where the first is exact, one
    where it lost one), members that then agree are within two bits of each other, and each is
    linked to the smallest of them, one row a member and group.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("two segments with one deleted bit find at most two differing bits")
    index = signatures(fps).withColumn("n", F.count("*").over(Window.partitionBy("key")))
    crowd = written(index.where("n > 1"), "crowds").withColumn("side", _side())
    some = crowd.where(F.col("n") <= hot)
    left, right = some.alias("l"), some.alias("r")
    opposite = "(l.side = 0 and r.side = 1 or l.side = -1 and r.side = -1 and l.fp < r.fp)"
    met = left.join(right, F.expr(f"l.key = r.key and {opposite}"))
    pairs = met.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")).where(_distance() <= max_bits)
    return pairs.union(_hot_links(crowd.where(F.col("n") > hot), max_bits)).distinct()


def _hot_links(crowd: DataFrame, max_bits: int) -> DataFrame:
    """Star links of large buckets, without pairs. The bits that may be deleted from the other
    segment are those that the first has left of ``max_bits``."""
    other = F.expr("if(key < shiftleft(33L, 32), shiftrightunsigned(fp, 32), fp & 4294967295L)")
    rows = crowd.select("key", "fp", other.alias("other"), (F.lit(max_bits) - (F.col("side") >= 0).cast("int")).alias("left"))
    one = F.expr("transform(sequence(0, 31), i -> shiftleft(1L, i))")
    two = F.expr(
        "flatten(transform(sequence(1, 31), i -> transform(sequence(0, i - 1), j -> shiftleft(1L, i) | shiftleft(1L, j))))"
    )
    masks = F.when(F.col("left") == 2, two).when(F.col("left") == 1, one).when(F.col("left") == 0, F.array(F.lit(0).cast("long")))
    rows = rows.withColumn("mask", F.explode(masks))
    group = ["key", "mask", F.col("other").bitwiseAND(F.bitwise_not("mask")).alias("rest")]
    rows = rows.select(*group, "fp")
    least = rows.groupBy("key", "mask", "rest").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    return rows.join(least, ["key", "mask", "rest"]).where("fp <> a").select("a", F.col("fp").alias("b"))


def groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The documents (id, fp), one row per input row, and every distinct fingerprint (fp, root,
    component_id): the smallest fingerprint and the smallest id of its component."""
    own = written(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
    fps = written(own.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(near_links(fps.select("fp"), max_bits))
    fps = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    fps = fps.withColumn("root", F.coalesce("root", "fp"))
    least = fps.groupBy("root").agg(F.min("least").alias("component_id"))
    return own, written(fps.join(least, "root").select("fp", "root", "component_id"), "components")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    own, fps = groups(docs, id_col, text_col, shingle, max_bits)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return own.join(fps, "fp").select(F.col("id").alias(id_col), digits, "component_id")


def _one_row(rows: DataFrame, key: str, text_col: str) -> DataFrame:
    """One row a key: that of the smallest hashes of its text and of all its values."""
    order = F.struct(F.xxhash64(text_col), F.xxhash64(*rows.columns))
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*rows.columns), order).alias("_row")).select("_row.*")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """``docs`` with one document of each group: the one whose id is the group's smallest. Rows
    that repeat that id count as one document: the row whose text, then whose whole row, has the
    smallest hash stays, whatever task reads it again. Rows without an id stay only if no document
    with an id is in their group, one for each such group. All columns as they were."""
    _, fps = groups(docs, id_col, text_col, shingle, max_bits)
    first = fps.select(F.col("component_id").alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(first, id_col, "left_semi")
    named = _one_row(named.select(*docs.columns), id_col, text_col)
    rest = docs.where(F.col(id_col).isNull())
    texts = rest.select(F.coalesce(text_col, F.lit("")).alias("text")).distinct().withColumn("id", F.xxhash64("text"))
    lone = with_fingerprint(texts, "id", "text", shingle).join(fps.where("component_id is null"), "fp")
    lone = lone.groupBy("root").agg(F.min("id").alias("id")).select("id")
    rest = rest.join(lone, F.xxhash64(F.coalesce(rest[text_col], F.lit(""))) == lone["id"], "left_semi")
    rest = _one_row(rest.select(*docs.columns), text_col, text_col)
    return named.select(*docs.columns).unionByName(rest.select(*docs.columns))

"""BPE encoding and decoding by prefix-sharing trie traversal (operator 9).

For a BPE vocabulary of ranked merges, an encoding is valid if and only if each pair of
neighbouring tokens is, and every prefix of a valid encoding is valid. So a prefix of a word is
described by the last token of its encoding alone: the one vocabulary token that ends there and
makes a valid pair with the last token of what is before it. The distinct words of a batch are
walked as a trie, depth first in sorted order: a word keeps the states of the prefix that it
shares with the word before it, and adds one state for each further byte. A word's last byte is
a symbol of its own (with the end-of-word mark), so it is added beside the shared prefix.

The tokenizer file (BPE with an end-of-word suffix, NFC, white space, lower case, a split
pattern, byte-level symbols) is read by the driver and broadcast: its size does not depend on
the data. Text is cut at white space first, as no word spans it; each distinct piece is
normalised words once and remembered, up to ``REMEMBERED`` pieces a worker.

Defined cases: null counts as the empty text, which has no tokens; a null id stays null;
repeated rows give repeated results; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ddl, small_batches

REMEMBERED = 600_000
REMEMBERED_PAIRS = 1_000_000
#: str.split() also cuts at these, which are not white space to the tokenizer.
SEPARATORS = regex.compile("[\x1c-\x1f]")
WHITE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: Latin-1's visible ones for themselves,
    the rest from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and the states' rules of one tokenizer file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        ids = model["vocab"]
        self.token_of = {i: t for t, i in ids.items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token_of.update({i: t for t, i in self.special.items()})
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.symbols = {b: s for b, s in enumerate(_byte_symbols())}

        #: Of two tokens, the rank and the token of their merge; of a token, its rank and parts.
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = dict.fromkeys(ids.values(), -1)
        for n, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            t = ids[a + b]
            self.merge[ids[a], ids[b]] = (n, t)
            if t not in self.parts:
                self.parts[t], self.rank[t] = (ids[a], ids[b]), n
        self._valid: dict[tuple[int, int], bool] = {}
        self._made: dict[int, bool] = {}
        self.inner, self.final = {}, {}
        for text, t in ids.items():
            if self._is_made(t):
                if text.endswith(suffix) and text != suffix:
                    self.final[text[: -len(suffix)]] = t
                else:
                    self.inner[text] = t
        self.longest = max(map(len, [*self.inner, *self.final]))

    def _is_made(self, t: int) -> bool:
        """Whether the merges make the token of its own text."""
        if t not in self._made:
            if t not in self.parts:
                self._made[t] = len(self.token_of[t].replace("</w>", "")) <= 1
            else:
                a, b = self.parts[t]
                self._made[t] = self._is_made(a) and self._is_made(b) and self._holds(a, b, self.rank[t])
        return self._made[t]

    def _holds(self, a: int, b: int, before: int) -> bool:
        """Whether no merge across the seam of a and b comes before the merge ``before``, nor
        before the merges that made the tokens at the seam. Those are undone from the latest:
        at each step the seam has the tokens that were there before that merge."""
        while True:
            over = self.merge.get((a, b))
            ra, rb = self.rank[a], self.rank[b]
            if over is not None and over[0] < before:
                return False
            if ra < 0 and rb < 0:
                return True
            if ra > rb:  # undone on the left: a merge over the seam of the same rank came later
                before, a = ra, self.parts[a][1]
            else:  # on the right of the seam: an equal rank over the seam came first
                before, b = rb + 1, self.parts[b][0]

    def valid(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' text is the two tokens."""
        return self._holds(a, b, 1 << 60)

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """The tokens of each distinct word, given as byte symbols.

        ``last[k]`` and ``size[k]``: the last token of the first k symbols, and its length. At
        most one token that ends at k is valid after what is before it, so the first that is
        found, from the shortest, is the one."""
        if len(self._valid) >= REMEMBERED_PAIRS:
            self._valid.clear()
        valid, longest = self._valid, self.longest
        out: dict[str, list[int]] = {}
        before, last, size = "", [0], [0]
        for word in sorted(words):
            n = len(word) - 1  # inner symbols; the last one closes the word
            same, most = 0, min(n, len(last) - 1)
            while same < most and word[same] == before[same]:
                same += 1
            del last[same + 1 :], size[same + 1 :]
            get = self.inner.get
            for k in range(same + 1, n + 2):
                if k > n:
                    get = self.final.get
                for length in range(1, min(k, longest) + 1):
                    start = k - length
                    t = get(word[start:k])
                    if t is None:
                        continue
                    if not start:
                        break
                    pair = last[start] << 20 | t
                    ok = valid.get(pair)
                    if ok is None:
                        ok = valid[pair] = self.valid(last[start], t)
                    if ok:
                        break
                else:
                    raise ValueError(f"no token ends {word[:k]!r}")
                if k <= n:
                    last.append(t)
                    size.append(length)
            ids, k = [t], n + 1 - length
            while k:
                ids.append(last[k])
                k -= size[k]
            out[word] = ids[::-1]
            before = word
        return out

    def words(self, piece: str) -> list[str]:
        """A normalised piece's words, as byte symbols."""
        if piece.isalpha():
            cut = [piece]
        elif piece[-1] in ".," and piece[:-1].isalpha():
            cut = [piece[:-1], piece[-1]]
        else:
            cut = self.pattern.findall(piece)
        if piece.isascii() and piece.isprintable():  # visible ASCII stands for itself
            return cut
        s = self.symbols
        return ["".join([s[b] for b in w.encode("utf-8")]) for w in cut]

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens are joined by a space."""
        return " ".join([self.token_of[i] for i in ids])


@functools.lru_cache(2)
def vocabulary(source: str) -> Vocabulary:
    return Vocabulary(source)


def normalised(text: str) -> str:
    """NFC, then each character's own lower case (no final sigma)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces(text: str) -> list[str]:
    """The normalised text cut at white space."""
    low = normalised(text)
    return [x for x in WHITE.split(low) if x] if SEPARATORS.search(low) else low.split()


class Encoder:
    """Remembers the ids and tokens, each space-joined, of words and of pieces."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.words: dict[str, tuple[str, str]] = {}
        self.pieces: dict[str, tuple[str, str]] = {}

    def learn(self, new: set[str]) -> None:
        v, words = self.v, self.words
        cut = {p: v.words(p) for p in new}
        unknown = {w for ws in cut.values() for w in ws}.difference(words)
        for w, ids in v.encode_words(unknown).items():
            words[w] = " ".join(map(str, ids)), v.decode(ids)
        for p, ws in cut.items():
            if len(ws) == 1:
                self.pieces[p] = words[ws[0]]
            else:
                self.pieces[p] = tuple(map(" ".join, zip(*[words[w] for w in ws], strict=True)))

    def run(self, texts: list[str]) -> list[tuple[str, str]]:
        """Each text's ids and decoded text, both space-joined."""
        if len(self.pieces) > REMEMBERED:
            self.words.clear()
            self.pieces.clear()
        cut = [self._pieces(t) for t in texts]
        new = set().union(*cut).difference(self.pieces)
        if new:
            self.learn(new)
        out, known = [], self.pieces.__getitem__
        for ps in cut:
            found = list(map(known, ps))
            out.append((" ".join([x for x, _ in found]), " ".join([x for _, x in found])))
        return out

    def _pieces(self, text: str) -> list[str]:
        v = self.v
        if "<" not in text or not v.cut.search(text):
            return pieces(text)
        out, at = [], 0
        for m in v.cut.finditer(text):
            out += pieces(text[at : m.start()])
            mark = f" {m[0]}"  # no piece has a space
            self.pieces[mark] = str(v.special[m[0]]), m[0]
            out.append(mark)
            at = m.end()
        return out + pieces(text[at:])


@functools.lru_cache(2)
def encoder(source: str) -> Encoder:
    return Encoder(vocabulary(source))


def _mapped(docs: DataFrame, id_col: str, text_col: str, file: str, row, schema: pa.Schema) -> DataFrame:
    small_batches(docs.sparkSession)
    with open(file, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        enc = encoder(source.value)
        for b in batches:
            out = enc.run([t or "" for t in b.column(1).to_pylist()])
            rows = list(zip(*[row(ids, text) for ids, text in out], strict=True)) or [()] * len(schema)
            cols = [pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[id_col, *schema.names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, {ddl(schema)}")


def _count(ids: str) -> int:
    return ids.count(" ") + 1 if ids else 0


def encode(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_tokens``, ``ids`` (decimal, space-joined) and
    ``decoded``. ``file`` is the tokenizer file's path on the driver."""
    schema = pa.schema([("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])
    return _mapped(docs, id_col, text_col, file, lambda ids, text: (_count(ids), ids, text), schema)


def encode_digests(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with SHA-256 digests for the ids and the decoded text."""
    schema = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    digest = lambda x: hashlib.sha256(x.encode("utf-8")).hexdigest()
    return _mapped(docs, id_col, text_col, file, lambda ids, text: (_count(ids), digest(ids), digest(text)), schema)

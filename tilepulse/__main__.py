"""``python -m tilepulse --date 2025-12-01``: same as ``tilepulse/cli.py``."""

from tilepulse.cli import main

main()

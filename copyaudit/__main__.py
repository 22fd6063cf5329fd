"""``python -m copyaudit <command> <arguments>`` (see ``copyaudit.cli``)."""

import sys

from copyaudit.cli import main

if __name__ == "__main__":
    sys.exit(main())

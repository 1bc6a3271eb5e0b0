import sys

from tradewell.cli import main

sys.exit(main())

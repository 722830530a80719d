import sys

from curata.cli import main

sys.exit(main())

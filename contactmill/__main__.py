import sys

from contactmill.cli import main

sys.exit(main())

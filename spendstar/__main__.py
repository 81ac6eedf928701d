import sys

from spendstar.plans.cli import main

sys.exit(main())

"""``python -m pulsegrid run|ccu|cubes ...``"""

import sys

from pulsegrid.cli import main

sys.exit(main())

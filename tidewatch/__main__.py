import sys

from tidewatch.cli import main

main(sys.argv[1:])

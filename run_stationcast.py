"""spark-submit launcher: ``spark-submit --py-files stationcast.zip run_stationcast.py train|forecast ...``."""

from stationcast.plans.cli import main

if __name__ == "__main__":
    main()

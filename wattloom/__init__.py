"""Grid-carbon analytics as Spark jobs: telemetry feeds -> bronze -> silver -> gold -> forecast."""

__version__ = "0.1.0"

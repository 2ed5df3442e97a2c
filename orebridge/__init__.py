"""orebridge: sensor-versus-assay grade reconciliation on Spark DataFrames.

Layers:
  sources/    file readers and sinks, the fixture tables derived from `events`
  functions/  Column-level helpers (rounding, bands, calendar parts)
  operators/  generic DataFrame -> DataFrame operators (dedup, median, outliers, keys)
  plans/      the composite jobs: sensor/assay transforms, dimensions, views, report, warehouse
"""

from orebridge.session import build_session, checkpoint_dir, reliable_checkpoint

__all__ = ["build_session", "checkpoint_dir", "reliable_checkpoint"]

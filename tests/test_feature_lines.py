"""Feature tables as JSON lines."""

import glob
import gzip

from pyspark.sql import functions as F

from delaylab import schemas
from delaylab.sources import readers, writers


def test_lines_are_written_to_small_fast_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "LINES_ROWS", 10, raising=False)
    made = spark.range(45).select(*[
        (F.col("id") % 7).cast("string").alias(f.name) if f.name in ("Carrier", "Origin", "Dest", "FlightNum")
        else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.FEATURES.fields
    ])
    path = str(tmp_path / "lines")
    writers.write_features(made.coalesce(1), path, "json")
    files = glob.glob(f"{path}/*.json.gz")
    assert sorted(len(gzip.open(f).readlines()) for f in files) == [5, 10, 10, 10, 10]
    again = readers.read_features(spark, path, "json")
    assert again.schema == schemas.FEATURES
    assert sorted(map(str, again.collect())) == sorted(map(str, made.select(*again.columns).collect()))

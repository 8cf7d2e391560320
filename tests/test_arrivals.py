"""Files loaded as they arrive, with a batch repeated."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerstar.admissions import BILLING_RULES, INGESTED_ADMISSIONS, RAW_ADMISSIONS
from ledgerstar.operators.audit import AUDIT_SCHEMA
from ledgerstar.plans.ingest import Targets
from ledgerstar.streaming.arrivals import ingest_arrivals


def test_arriving_files_load_once(spark, tmp_path, f1_lines):
    arrivals = tmp_path / "in"
    arrivals.mkdir()
    targets = Targets.under(str(tmp_path / "out"), "admissions")

    def run(checkpoint):
        query = ingest_arrivals(
            spark,
            str(arrivals),
            targets,
            RAW_ADMISSIONS,
            INGESTED_ADMISSIONS,
            BILLING_RULES,
            str(tmp_path / checkpoint),
            files_per_batch=1,
        )
        query.awaitTermination()
        assert query.exception() is None
        return spark.read.parquet(targets.table).count()

    def arrive(name, lines):
        (arrivals / name).write_text("\n".join([f1_lines[0], *lines]) + "\n", encoding="utf-8")

    arrive("a.csv", f1_lines[1:7])
    assert run("first") == 3
    arrive("b.csv", f1_lines[4:])
    assert run("first") == 7
    # A lost checkpoint repeats every batch: nothing is loaded or set aside a second time.
    set_aside = lambda: spark.read.parquet(targets.quarantine).agg(F.sum("copies")).first()[0]
    quarantined = set_aside()
    assert run("second") == 7
    assert set_aside() == quarantined == 2 + 4
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(targets.audit)
    assert audit.filter(F.col("step") == "complete").count() == 4

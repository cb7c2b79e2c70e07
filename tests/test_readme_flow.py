"""The job sequence shown in the README, on local folders (keeps the docs honest)."""

from pyspark.sql import functions as F

from freightlake.operators import dims, gold, quality
from freightlake.operators.dedup import latest_per_key
from freightlake.operators.enrich import transform_silver
from freightlake.operators.schema_ops import add_audit, require_columns
from freightlake.plans import tables
from freightlake.sources import driver_tables as dt
from freightlake.sources.raw import read_layer, read_raw

SF = "/root/testdata/sf0.001"


def test_readme_job_sequence(spark, tmp_path):
    lake = str(tmp_path / "lake")
    raw_dir = str(tmp_path / "raw_eventos_2024-01-15")
    dt.plain_events(spark, SF).filter(F.to_date("updated_at") == "2024-01-15").write.parquet(raw_dir)
    dt.raw_wagons(spark, SF).write.parquet(f"{lake}/bronze/vagoes")
    dt.raw_contracts(spark, SF).write.parquet(f"{lake}/bronze/contratos")

    raw = require_columns(read_raw(spark, raw_dir), ["evento_id", "updated_at"])
    bronze = add_audit(latest_per_key(raw, "evento_id", "updated_at"), "eventos_ferroviarios",
                       "updated_at", run_id="bronze-2024-01-15", now="2024-01-16 01:30:00")
    tables.write_merged(spark, bronze, f"{lake}/bronze/eventos", "evento_id", newer="updated_at")

    events = read_layer(spark, f"{lake}/bronze/eventos", "2024-01-15")
    wagons = spark.read.parquet(f"{lake}/bronze/vagoes")
    contracts = spark.read.parquet(f"{lake}/bronze/contratos")
    silver = transform_silver(events, wagons, contracts, now="2024-01-16 02:30:00")
    tables.write_merged(spark, silver, f"{lake}/silver/eventos", "evento_id", newer="_silver_processed_at")
    found = quality.gate(quality.gate_failures(quality.gate_counts(silver), min_rows=10), fail_on_error=True)
    assert {f["severity"] for f in found} <= {"WARNING"}

    stg = gold.stg_events(tables.read_table(spark, f"{lake}/silver/eventos"))
    fact_rows = gold.build_fact(stg.filter("data_particao >= date'2024-01-12'"),
                                dims.wagon_dim(gold.stg_wagons(wagons)), dims.contract_dim(contracts),
                                now="2024-01-16 04:00:00")
    tables.write_merged(spark, fact_rows, f"{lake}/gold/fct", "evento_id", part_col="data_particao")
    mart = gold.sla_mart(gold.sla_daily(tables.read_table(spark, f"{lake}/gold/fct"), as_of="2024-01-16"))
    tables.write_table(mart, f"{lake}/gold/mart_sla_violations", part_col="data_particao")

    n = spark.read.parquet(raw_dir).count()
    assert tables.read_table(spark, f"{lake}/gold/fct").count() == n
    assert spark.read.parquet(f"{lake}/gold/mart_sla_violations").agg(F.sum("total_eventos")).collect()[0][0] == n

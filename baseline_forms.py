"""Times the usual form of a step next to the form used here; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS   as in bench.py
BENCH_COPIES               how often the lines are repeated under new invoices (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lamina.operators.incremental import new_rows  # noqa: E402
from lamina.operators.star import DIMENSIONS, KEY, LINE, dimension_rows, fact_rows, star  # noqa: E402
from lamina.operators.surrogate import sparse_ids  # noqa: E402
from lamina.plans.queries import STAMP, _silver, _stored  # noqa: E402
from lamina.session import local_session, materialize  # noqa: E402


def best(df, runs: int = 3) -> float:
    times = []
    for _ in range(runs):
        began = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - began)
    return round(min(times), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus, copies = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_COPIES", "8"))
    spark = local_session("forms", cores=cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")

    once = materialize(_silver(spark, folder), "once")
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    lines = materialize(
        once.withColumn("_copy", copy)
        .withColumn("INVOICENO", F.concat("INVOICENO", F.lit("-"), F.col("_copy")))
        .drop("_copy"),
        "lines",
    )
    stored = materialize(_stored(lines), "stored")
    dims = {
        grain: {
            d.table.name: materialize(sparse_ids(dimension_rows(lines, d, STAMP, grain).dropna(), d.id_col), "dim")
            for d in DIMENSIONS
        }
        for grain in (LINE, KEY)
    }
    outer = (
        lines.alias("n")
        .join(stored.alias("e"), "INVOICENO", "left_outer")
        .filter(F.col("e.INVOICENO").isNull())
        .select("n.*")
    )
    facts = sparse_ids(fact_rows(lines, STAMP), "INVOICE_FACT_ID")
    forms = {
        "increment_outer_join_is_null": outer,
        "increment_anti_join": new_rows(lines, stored, "INVOICENO"),
        "fact_line_grain_with_distinct": star(facts, dims[LINE], LINE).distinct(),
        "fact_line_grain": star(facts, dims[LINE], LINE),
        "fact_key_grain": star(facts, dims[KEY], KEY),
    }
    times = {name: best(df) for name, df in forms.items()}
    print(json.dumps({"metric": "forms", "rows": lines.count(), "unit": "sec", "queries": times}))
    spark.stop()


if __name__ == "__main__":
    main()

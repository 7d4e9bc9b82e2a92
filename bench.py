"""Headline queries on one machine; prints one JSON line.

Every query is timed to its last row: the chains over brand bars from the written bars, the others
from the raw tables. A first, untimed run of a small query starts the session. `--verbose` reports each query as it finishes.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.functions import columns as C  # noqa: E402
from barloom.functions import indicators as I  # noqa: E402
from barloom.operators import features, merge, split  # noqa: E402
from barloom.operators.series import measure  # noqa: E402
from barloom.registry import queries as registry  # noqa: E402
from barloom.session import build_session, cut, release  # noqa: E402
from barloom.sources import tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
STORED = {}


def brand_bars(spark, sf):
    return tables.bars_brand(spark, sf)


def write_brand_bars(spark, sf):
    """Derive the bars of 25 brands and write them; the chains below start from this table."""
    STORED["brand"] = cut(brand_bars(spark, sf), "bars")
    return STORED["brand"]


def brand(build):
    return lambda spark, sf: build(STORED["brand"])


def month_merge(spark, sf):
    rows = STORED["brand"]
    old = rows.where(C.month_key() <= "1999-12")
    new = rows.where(C.month_key() >= "1999-11").withColumn("close", rows["close"] + 1)
    return merge.upsert(old, new)


QUERIES = {
    "derive_bars": registry.bars,
    "derive_bars_brand": write_brand_bars,
    "training_features": brand(features.training),
    "indicator_set": brand(features.indicators),
    "moving_averages": brand(lambda df: measure(df, *features.moving_averages())),
    "macd": brand(lambda df: measure(df, I.macd("close"))),
    "sequence_windows": brand(lambda df: features.sequences(df, features.BASE)),
    "random_split": brand(split.random),
    "month_merge": month_merge,
    "walk_forward": registry.walk_forward_baseline,
    "alerts_batch": registry.alerts_batch,
    "alerts_stream": registry.str_alerts,
    "bars_240m": registry.bars_240m,
    "store_upsert": registry.upsert_month_merge,
    "forest": registry.ml_rf_predict,
    "sequence_model": registry.ml_walk_forward,
}


def run(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, registry.next_day_baseline)
    times = {}
    for name, query in QUERIES.items():
        times[name] = round(run(spark, query), 3)
        if "--verbose" in sys.argv:
            print(name, times[name], file=sys.stderr, flush=True)
    release(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()

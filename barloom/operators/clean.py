"""Record checks: good bars on one side, rejects with a reason on the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import columns as C
from barloom.schemas import CORRUPT, OHLCV, RECORDS


def mark_records(records: DataFrame) -> DataFrame:
    """Typed bar columns beside the landed `record`, and `reason`, null for a good record."""
    rest = [c for c in records.columns if c not in RECORDS.names and c != CORRUPT]
    corrupt = F.col(CORRUPT) if CORRUPT in records.columns else F.lit(None).cast("string")
    typed = {"date": C.to_day("Date"), **{n: C.known(n.capitalize()) for n in OHLCV}}
    missing = F.greatest(*[F.col(name).isNull() for name in OHLCV])
    nameless = F.coalesce(F.col("symbol"), F.lit("")) == "" if "symbol" in rest else F.lit(False)
    reason = (
        F.when(nameless, "no symbol")
        .when(F.col("_line").isNotNull(), "unreadable line")
        .when(F.col("date").isNull(), "no date")
        .when(missing, "missing value")
    )
    return records.select(
        *rest,
        F.struct(*RECORDS.names).alias("record"),
        corrupt.alias("_line"),
        *[value.alias(name) for name, value in typed.items()],
    ).withColumn("reason", reason)


def bars(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split landed records into bars and rejects. No record fails the job."""
    return parted(mark_records(records))


def parted(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good bars and the rejects of marked records."""
    own = {"record", "_line", "reason", "date", *OHLCV}
    rest = [c for c in marked.columns if c not in own]
    good = marked.where(F.col("reason").isNull()).select(*rest, "date", *OHLCV)
    rejects = marked.where(F.col("reason").isNotNull()).select(
        *rest, "record", F.col("_line").alias("line"), "reason"
    )
    return good, rejects


def pair_lines(lines: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Records from legacy `key<TAB>json` lines, with the columns to `keep`."""
    values = F.from_json(C.pair_value(col), "Open double, High double, Low double, "
                                            "Close double, Volume double")
    kept = keep or []
    return lines.select(*kept, C.pair_key(col).alias("Date"), values.alias("v")).select(
        *kept, "Date", "v.*"
    )

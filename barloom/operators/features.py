"""Feature chains, targets and sequence samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import columns as C
from barloom.functions import indicators as I
from barloom.operators.series import fill, measure, without_position
from barloom.operators.split import newest
from barloom.sources.readers import lookback

TECH = ["sma_5", "sma_20", "sma_60", "rsi", "macd", "hl_ratio"]
BASE = ["close", "open", "high", "low", "volume"]
# The named feature sets.
FEATURE_SETS = {
    "rf": ["close", "volume", "macd", "signal_line"],
    "base": BASE,
    "base_tech": BASE + TECH,
    "diff": [f"{c}_diff" for c in BASE],
    "diff2": [f"{c}_diff2" for c in BASE],
    "change": [f"{c}_change" for c in BASE],
    "diff_tech": [f"{c}_diff" for c in BASE] + TECH,
    "diff2_tech": [f"{c}_diff2" for c in BASE] + TECH,
    "change_tech": [f"{c}_change" for c in BASE] + TECH,
}


def moving_averages(prefix: str = "ma") -> list:
    return [I.sma("close", n, f"{prefix}{n}") for n in (5, 20, 60)]


def price_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"price_range": C.price_range(), "price_change": C.price_change()})


def bfill(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Next known value in date order; trailing gaps stay, infinities are values."""
    names = [c for c in df.columns if c not in ("symbol", "date") and not c.startswith("_")]
    return fill(df, cols or names, forward=False)


# Columns that start late or may be undefined; where bars are complete the others are known.
GAPPED = ["ma5", "ma20", "ma60", "volume_ma5", "daily_return", "weekly_return", "rsi"]


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """`df` that fails, with the place, where one of `cols` is missing.

    Averages and changes over a gap need another chain; a wrong number would go unnoticed.
    """

    def checked(name):
        where = F.concat_ws(" ", F.lit(f"{name} is missing, pass gaps=True:"), "symbol", F.col("date").cast("string"))
        return F.when(F.col(name).isNull(), F.raise_error(where)).otherwise(F.col(name))

    return df.withColumns({c: checked(c) for c in cols})


def _with_macd(df: DataFrame, *rest, gaps: bool, signal: str, histogram: str | None, keep: bool) -> DataFrame:
    """`rest` and the MACD lines; over gaps the averages take passes of their own."""
    if not gaps:
        return measure(df, *rest, I.macd("close", "macd", signal, histogram), keep_position=keep)
    out = macd_over_gaps(measure(df, *rest), "close", "macd", signal, histogram)
    return measure(out, keep_position=True) if keep else out


def training(
    df: DataFrame,
    backfill: bool = True,
    more: tuple = (),
    gaps: bool = False,
    cols: list[str] | None = None,
) -> DataFrame:
    """Training features of the tree model. Back-fill lets the first rows see later ones.

    `more` indicators, such as the target, ride along in the same pass and are not back-filled.
    With `cols`, features not among them are left out, and so is what only they need. Bars with
    missing values fail unless `gaps` is set: then changes take the last known close for a missing
    one, averages age over gaps, and every column is back-filled.
    """
    def wanted(name):
        return cols is None or name in cols

    returns = [(n, k) for n, k in (("daily_return", 1), ("weekly_return", 5)) if wanted(n)]
    means = [
        i for i in (*moving_averages(), I.sma("volume", 5, "volume_ma5"), I.rsi("close", "rsi"))
        if wanted(i.outputs[0])
    ] + list(more)
    if gaps:
        rows = df
        for name, k in returns:
            rows = change(rows, "close", name, k)
    else:
        uses = {"volume": "volume_ma5", "open": "price_change", "high": "price_range", "low": "price_range"}
        rows = require(df, [c for c in BASE if c == "close" or wanted(c) or wanted(uses[c])])
        means += [I.pct_change("close", name, k) for name, k in returns]
    late = [c for c in GAPPED if wanted(c)]
    keep = backfill and (gaps or bool(late))
    out = _with_macd(rows, *means, gaps=gaps, signal="signal_line", histogram=None, keep=keep)
    out = price_features(out)
    if not keep:
        return out
    extra = {"symbol", "date", *(name for item in more for name in item.outputs)}
    every = [c for c in out.columns if c not in extra and c[0] != "_"]
    return without_position(bfill(out, every if gaps else late))


def serving(
    df: DataFrame, as_of=None, days: int = 90, backfill: bool = True, gaps: bool = False
) -> DataFrame:
    """Serving features. With `as_of`, averages start inside the last `days` days."""
    rows = df if as_of is None else lookback(df, as_of, days)
    out = _with_macd(
        rows if gaps else require(rows, BASE),
        *moving_averages(),
        I.sma("volume", 5, "volume_ma5"),
        gaps=gaps, signal="signal_line", histogram=None, keep=backfill,
    )
    return without_position(bfill(out, None if gaps else GAPPED[:4])) if backfill else out


def indicators(
    df: DataFrame, complete: bool = True, more: tuple = (), gaps: bool = False
) -> DataFrame:
    """The indicator set of the sequence study; `complete` drops rows with any missing value."""
    rest = [
        *moving_averages("sma_"),
        I.rsi("close", "rsi"),
        *[I.diff(c, f"{c}_diff") for c in BASE],
        *[I.diff(c, f"{c}_diff2", 2) for c in BASE],
        *more,
    ]
    if gaps:
        rows = df
        for c in BASE:
            rows = change(rows, c, f"{c}_change")
    else:
        rows = require(df, BASE)
        rest += [I.pct_change(c, f"{c}_change") for c in BASE]
    out = _with_macd(rows, *rest, gaps=gaps, signal="signal", histogram="histogram", keep=False)
    out = out.withColumn("hl_ratio", C.hl_ratio())
    return complete_rows(out) if complete else out


def supervised(df: DataFrame, cols: list[str], gaps: bool = False) -> DataFrame:
    """`cols` of the chain that has them all, and the next close as `target`, in one pass.

    The newest row has no target. Columns that no chain has are an error.
    """
    lead = (I.lead("close", 1, "target"),)
    for chain in (training, indicators):
        if set(cols) <= _chain_columns(chain):
            own = {"cols": cols} if chain is training else {"complete": False}
            out = chain(df, more=lead, gaps=gaps, **own)
            out = out.select("symbol", "date", *dict.fromkeys(["close", *cols]), "target")
            return out if chain is training else out.dropna(subset=cols)
    raise ValueError(f"no chain has the columns {sorted(cols)}")


def _chain_columns(chain) -> set[str]:
    prices = {*BASE, "price_range", "price_change", *GAPPED, "macd", "signal_line"}
    sets = {c for names in FEATURE_SETS.values() for c in names} | {"signal", "histogram"}
    return prices if chain is training else (sets - {"signal_line"})


def complete_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def select(df: DataFrame, features: str | list[str]) -> DataFrame:
    """Symbol, date and the features of a set that exist; `supervised` wants them all."""
    names = FEATURE_SETS[features] if isinstance(features, str) else features
    return df.select("symbol", "date", *[c for c in names if c in df.columns])


def target(df: DataFrame, col: str = "close", k: int = 1, out: str = "target") -> DataFrame:
    """Pair each row with `col` of k rows later; the last k rows have none and go."""
    return measure(df, I.lead(col, k, out)).where(F.col(out).isNotNull())


def sequences(
    df: DataFrame, cols: list[str], target: str = "close", length: int = 120
) -> DataFrame:
    """The `length` rows before each row as `x`, and the row's own `target` as `y`."""
    rows = df.select("symbol", "date", *dict.fromkeys([*cols, target]))
    return (
        measure(rows, I.windows(cols, length, "x"))
        .where(F.col("x").isNotNull())
        .select("symbol", "date", "x", F.col(target).alias("y"))
    )


def last_window(df: DataFrame, cols: list[str], length: int = 120, skip: int = 30) -> DataFrame:
    """Per symbol, the `length` rows before the last `skip` ones, oldest first."""
    item = F.struct("date", F.array(*cols).alias("v"))
    return (
        newest(df, length + skip)
        .where(F.col("_back") > skip)
        .groupBy("symbol")
        .agg(F.array_sort(F.collect_list(item)).alias("_rows"))
        .where(F.size("_rows") == length)
        .select("symbol", F.transform("_rows", lambda r: r["v"]).alias("x"))
    )


def latest(df: DataFrame) -> DataFrame:
    """The newest row per symbol.

    One aggregate per column: buffers of fixed width stay in a hash aggregate, where a whole row
    as one struct would have every task sort its input.
    """
    rest = [c for c in df.columns if c not in ("symbol", "date")]
    newest = [F.max_by(c, "date").alias(c) for c in rest]
    return df.groupBy("symbol").agg(F.max("date").alias("date"), *newest)



def change(df: DataFrame, col: str, out: str, k: int = 1) -> DataFrame:
    """Percent change of a column with gaps: a missing value stands for the last known one."""
    known = f"_{col}_known"
    rows = fill(df.withColumn(known, F.col(col)), [known], forward=True)
    return measure(rows, I.pct_change(known, out, k)).drop(known)


def ema_over_gaps(df: DataFrame, col: str, span: int, out: str) -> DataFrame:
    """Exponential average of a column with gaps.

    A gap ages the old average by its rows and repeats it; leading gaps stay missing.
    """
    rows = measure(df, I.ema_known_rows(col, span, out), keep_position=True)
    return without_position(fill(rows, [out], forward=True))


def macd_over_gaps(
    df: DataFrame,
    col: str = "close",
    out: str = "macd",
    signal_out: str = "signal",
    histogram_out: str | None = "histogram",
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
) -> DataFrame:
    """The MACD lines of a column with gaps; they start with its first known value."""
    names = [f"{out}_ema{span}" for span in (fast, slow)]
    for name, span in zip(names, (fast, slow), strict=True):
        df = ema_over_gaps(df, col, span, name)
    df = df.withColumn(out, F.col(names[0]) - F.col(names[1])).drop(*names)
    df = ema_over_gaps(df, out, signal, signal_out)
    return df.withColumn(histogram_out, F.col(out) - F.col(signal_out)) if histogram_out else df

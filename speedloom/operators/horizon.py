"""Future-state labels, class weights and the train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from speedloom import fixed_values as fv
from speedloom.functions.params import parameters


def lead_steps(horizon_min: int, freq_min: int) -> int:
    return max(1, horizon_min // max(1, freq_min))


def _with_label(df: DataFrame, congested: DataFrame | Row) -> DataFrame:
    state = parameters(congested, "congested")["congested"]
    return df.withColumn("label", F.when(F.col("prediction_next") == state, 1).otherwise(0))


def label_by_rows(slots: DataFrame, congested: DataFrame | Row, steps: int,
                  needed: tuple[str, ...] = fv.FEATURES) -> DataFrame:
    """State ``steps`` rows later on the same day, and whether it is the congested one.

    Slots are unique per time, so a day holds at most 1440 / freq_min of them: the
    window's groups are bounded by the clock and not by the number of readings.
    """
    day = Window.partitionBy(F.to_date("timestamp")).orderBy("timestamp")
    labelled = slots.withColumn("prediction_next", F.lead("prediction", steps).over(day)).dropna(
        subset=["prediction_next", "prediction", "timestamp", *needed])
    return _with_label(labelled, congested)


def label_by_time(slots: DataFrame, congested: DataFrame | Row, horizon_min: int) -> DataFrame:
    """State exactly ``horizon_min`` later, across gaps and midnight; none, no row."""
    later = slots.select(
        (F.col("timestamp") - F.expr(f"INTERVAL '{int(horizon_min)}' MINUTE")).alias("timestamp"),
        F.col("prediction").alias("prediction_next"))
    return _with_label(slots.join(later, "timestamp"), congested)


def split_bucket(key: Column, buckets: int = 10) -> Column:
    """Stable bucket of a text key, the same in every run and on every engine."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    return head % F.lit(buckets).cast("long")


def time_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def with_test_flag(df: DataFrame, test_tenths: int = 2) -> DataFrame:
    """Add ``is_test`` for the given tenths of rows, chosen by time stamp hash."""
    bucket = split_bucket(time_key(F.col("timestamp")))
    return df.withColumn("is_test", bucket >= 10 - test_tenths)


def with_purged_split(df: DataFrame, horizon_min: int, blocks: int = 10, every: int = 5) -> DataFrame:
    """Add ``is_test`` by blocks of time; null for rows that belong to neither side.

    The span is cut into equal ``blocks`` and every ``every``-th of them tests. Train rows within one horizon of a
    test block are left out: their label lies in it, or a test row's label lies with them.
    """
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    # Two numbers of the whole table, taken in the same plan.
    span = df.agg(F.struct(F.min(at).alias("first"), F.max(at).alias("last")).alias("s")).scalar()
    width = F.greatest(F.ceil((span["last"] - span["first"] + 1) / F.lit(blocks)), F.lit(1))
    since = at - span["first"]
    block, embargo = F.floor(since / width), F.lit(horizon_min * 60_000_000)
    testing = lambda b: F.pmod(b, F.lit(every)) == every - 1
    # A horizon may be longer than a block: the next and the last test block are reckoned, not the neighbours.
    ahead = (block + F.pmod(F.lit(every - 1) - block, F.lit(every))) * width - since
    behind = since - (block - F.pmod(block - (every - 1), F.lit(every)) + 1) * width
    nearby = (ahead <= embargo) & (block + F.pmod(F.lit(every - 1) - block, F.lit(every)) < blocks) | (
        (behind < embargo) & (block >= every))
    return df.withColumn("is_test", F.when(testing(block), True).when(~nearby, False))


def train_rows(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_test"))


def test_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_test"))


def positive_weight() -> Column:
    """Aggregate: negatives per positive; null unless both classes occur."""
    pos, neg = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    return F.when(neg > 0, F.try_divide(neg, pos))


def class_balance(df: DataFrame) -> DataFrame:
    """One row: labelled samples, positives, negatives, split sizes, positive weight."""
    pos, neg = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    aggs = [
        F.count("*").alias("samples"), pos.alias("n_pos"), neg.alias("n_neg"),
        positive_weight().alias("pos_weight"),
    ]
    if "is_test" in df.columns:
        aggs += [F.count_if(~F.col("is_test")).alias("train_rows"),
                 F.count_if("is_test").alias("test_rows")]
    return df.agg(*aggs)


def with_class_weight(df: DataFrame, balance: DataFrame | Row | None = None) -> DataFrame:
    """Add ``weight``: negatives 1, positives n_neg / n_pos.

    ``balance`` holds ``pos_weight``; by default it is counted on the train rows.
    """
    if balance is None:
        balance = class_balance(train_rows(df) if "is_test" in df.columns else df)
    pos_weight = parameters(balance, "pos_weight")["pos_weight"]
    return df.withColumn("weight", F.when(F.col("label") == 1, pos_weight).otherwise(F.lit(1.0)))

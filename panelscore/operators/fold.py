"""History fold: one wide row per key from an ordered per-key history.

Per feature ``c``: ``c_mean`` (AVG), ``c_max`` (MAX), ``c_last`` (value at the highest sequence number,
NULL kept); ``rn_cnt`` (rows per key); ``c_trend`` = COALESCE(AVG(c - LAG(c)), 0) along the sequence for
the trend columns; ``c_recent{N}`` = AVG(c) over rows whose sequence number is greater than the key's
maximum minus N (the last N *numbers*, SURVEY H7) for the recent columns.

Skew safety. A window partitioned by the key alone would put every row of a hot key into one task. Here
the rows of a key are cut into segments of ``segment`` consecutive sequence numbers; windows and the
first aggregate run per (key, segment), so no task ever buffers more than ``segment`` + N - 1 rows of one
group. A second, small aggregate combines the per-segment summaries of each key: sums and counts add up,
``last`` is taken from the highest segment, the LAG step across a segment border is
``first(segment) - last(previous segment)``, and rows of the recent-N range that lie just below a segment
border are copied ("carried") into the next segment, so that the recent mean is complete in the key's
highest segment. The result is exact; it needs (key, sequence) to be unique (``duplicate_sequences``).

Plan choice (``strategy="auto"``). Without trend and recent columns there is no window, and one map-side
combined aggregate is skew-safe as it is. With them, the largest number of rows under one key is measured
(a one-column scan and a narrow aggregate; one number reaches the driver): if no key has more than
``segment`` rows, every per-key window group is proven small and the single-window plan runs: one exchange on
the key, one sort, one window, one aggregate (SURVEY T1). Otherwise the segmented plan runs. Both
give the same rows, types and errors, for NULL keys and NULL sequence numbers too: a NULL key is a key like any
other; rows with a NULL number come first in the sequence; rows with equal numbers are ordered by the trend columns;
sums are kept as AVG keeps them (doubles, or decimals for decimal columns).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

# The reference's trend and recent-N feature columns (for its own history schema) and N.
REFERENCE_TREND = ("pre_util", "pre_loans_outstanding")
REFERENCE_RECENT = ("pre_util", "pre_loans_outstanding", "enc_loans_credit_status")
REFERENCE_RECENT_N = 3

DEFAULT_SEGMENT = 1 << 16


@dataclass(frozen=True)
class FoldSpec:
    key: str = "id"
    seq: str = "rn"
    features: tuple[str, ...] | None = None  # None: every column but key and seq (P1)
    trend: tuple[str, ...] = REFERENCE_TREND
    recent: tuple[str, ...] = REFERENCE_RECENT
    recent_n: int = REFERENCE_RECENT_N
    segment: int = DEFAULT_SEGMENT

    def feature_list(self, df: DataFrame) -> list[str]:
        if self.features is not None:
            return list(self.features)
        return feature_columns(df, exclude=(self.key, self.seq))

    def check(self, df: DataFrame) -> None:
        missing = [c for c in (self.key, self.seq, *self.trend, *self.recent) if c not in df.columns]
        if missing:
            raise ValueError(f"history lacks columns {missing}")
        if self.recent and not 1 <= self.recent_n <= self.segment:
            raise ValueError("recent_n must be at least 1 and at most segment")


def feature_columns(df: DataFrame, exclude=()) -> list[str]:
    """Schema-driven feature list: every column but the excluded ones, in table order."""
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


def duplicate_sequences(history: DataFrame, key: str = "id", seq: str = "rn") -> DataFrame:
    """(key, seq) pairs that occur more than once; must be empty for a deterministic fold (H5)."""
    return (history.groupBy(key, seq).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def _segment_of(seq: Column, width: int) -> Column:
    return F.floor(seq / F.lit(width)).cast("long")


def _segmented(history: DataFrame, spec: FoldSpec, carry: int) -> DataFrame:
    """Adds ``_seg`` and ``_carry``; rows within ``carry`` numbers below a border get a carried copy."""
    seq = F.col(spec.seq)
    seg = _segment_of(seq, spec.segment)
    if carry <= 0:
        return history.withColumns({"_seg": seg, "_carry": F.lit(False)})
    ahead = _segment_of(seq + F.lit(carry), spec.segment)
    copies = F.when(ahead != seg, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return (history.withColumn("_carry", F.explode(copies))
            .withColumn("_seg", seg + F.col("_carry").cast("long")))


def _sum(v: Column, kind: DataType) -> Column:
    """A partial sum as AVG keeps it: exact for decimals, else in doubles (no integer overflow)."""
    return F.sum(v if isinstance(kind, DecimalType) else v.cast("double"))


def _mean(total: Column, n: Column, kind: DataType) -> Column:
    """AVG from its sum and count, with AVG's type for a column of type ``kind``."""
    if isinstance(kind, DecimalType):
        precision, scale = min(kind.precision + 4, 38), min(kind.scale + 4, 38)
        return F.try_divide(total, n.cast("decimal(20,0)")).cast(DecimalType(precision, scale))
    return F.try_divide(total.cast("double"), n)


def _step_type(kind: DataType) -> DataType:
    return DecimalType(min(kind.precision + 1, 38), kind.scale) if isinstance(kind, DecimalType) else kind


def _segment_summaries(history: DataFrame, spec: FoldSpec, feats: list[str]) -> DataFrame:
    """One row per (key, segment) holding everything the per-key combine needs."""
    key, seq = spec.key, F.col(spec.seq)
    kinds = {f.name: f.dataType for f in history.schema.fields}
    rows = _segmented(history, spec, carry=spec.recent_n - 1 if spec.recent else 0)
    real = ~F.col("_carry")
    # real rows sort before carried ones, so LAG inside a segment only ever sees real rows
    w = Window.partitionBy(key, "_seg").orderBy("_carry", spec.seq, *spec.trend)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    extra = {f"_step_{c}": F.when(real, F.col(c) - F.lag(c).over(w)) for c in spec.trend}
    extra["_seg_max"] = F.max(F.when(real, seq)).over(whole)
    if spec.trend:
        extra["_first"] = real & F.lag("_carry").over(w).isNull()
        extra["_last"] = real & F.coalesce(F.lead("_carry").over(w), F.lit(True))
    stepped = rows.withColumns(extra)
    on_last = real & (seq == F.col("_seg_max"))
    aggs = [F.count(F.when(real, F.lit(1))).alias("_rows"), F.max("_seg_max").alias("_top")]
    for c in feats:
        v = F.when(real, F.col(c))
        aggs += [_sum(v, kinds[c]).alias(f"_s_{c}"), F.count(v).alias(f"_n_{c}"),
                 F.max(v).alias(f"_x_{c}"), F.max(F.when(on_last, F.col(c))).alias(f"_l_{c}")]
    for c in spec.trend:
        aggs += [_sum(F.col(f"_step_{c}"), _step_type(kinds[c])).alias(f"_ds_{c}"), F.count(f"_step_{c}").alias(f"_dn_{c}"),
                 F.max(F.when(F.col("_first"), F.col(c))).alias(f"_f_{c}"),
                 F.max(F.when(F.col("_last"), F.col(c))).alias(f"_e_{c}")]
    if spec.recent:
        in_range = seq > F.col("_seg_max") - F.lit(spec.recent_n)
        for c in spec.recent:
            v = F.when(in_range, F.col(c).cast("double"))
            aggs += [F.sum(v).alias(f"_rs_{c}"), F.count(v).alias(f"_rc_{c}")]
    return stepped.groupBy(key, "_seg").agg(*aggs).where(F.col("_rows") > 0)


def largest_key(history: DataFrame, key: str = "id") -> int:
    """Rows under the most frequent key (0 for an empty history)."""
    counts = history.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.max("_n")).first()[0] or 0


def choose_strategy(history: DataFrame, spec: FoldSpec) -> str:
    return "single" if largest_key(history, spec.key) <= spec.segment else "segmented"


def fold_history(history: DataFrame, spec: FoldSpec = FoldSpec(), strategy: str = "auto") -> DataFrame:
    """The client mart (A17): one row per key, columns in the reference's order.

    ``strategy``: "auto" (measure, then choose), "single" (one window per key; only for histories whose
    keys are known to be small) or "segmented" (skew-safe)."""
    spec.check(history)
    feats = spec.feature_list(history)
    if strategy == "auto":
        strategy = choose_strategy(history, spec) if spec.trend or spec.recent else "single"
    if strategy == "single":
        return _fold_single(history, spec, feats)
    if strategy != "segmented":
        raise ValueError(f"unknown strategy {strategy!r}")
    return _fold_segmented(history, spec, feats)


def _fold_single(history: DataFrame, spec: FoldSpec, feats: list[str]) -> DataFrame:
    """The reference's formulation: one window spec (LAG and the key's highest sequence number share its
    sort, T1) and one aggregate on the same key, hence a single exchange. When the window runs anyway,
    ``last`` is the value on the row holding the key's highest sequence number (one aggregation buffer
    instead of max_by's two; NULL kept); without trend and recent columns there is no window, and
    ``max_by`` keeps the map-side partial aggregate."""
    key, seq = spec.key, F.col(spec.seq)
    out = []
    if spec.trend or spec.recent:
        w = Window.partitionBy(key).orderBy(spec.seq, *spec.trend)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        data = history.withColumns({**{f"_step_{c}": F.col(c) - F.lag(c).over(w) for c in spec.trend},
                                    "_max_seq": F.max(seq).over(whole)})
        on_last = seq == F.col("_max_seq")
        last = lambda c: F.max(F.when(on_last, F.col(c)))
    else:
        data = history
        last = lambda c: F.max_by(F.col(c), seq)
    for c in feats:
        out += [F.avg(c).alias(f"{c}_mean"), F.max(c).alias(f"{c}_max"), last(c).alias(f"{c}_last")]
    out.append(F.count(F.lit(1)).alias(f"{spec.seq}_cnt"))
    out += [F.coalesce(F.avg(f"_step_{c}"), F.lit(0.0)).alias(f"{c}_trend") for c in spec.trend]
    if spec.recent:
        in_range = seq > F.col("_max_seq") - F.lit(spec.recent_n)
        out += [F.avg(F.when(in_range, F.col(c).cast("double"))).alias(f"{c}_recent{spec.recent_n}")
                for c in spec.recent]
    return data.groupBy(key).agg(*out)


def _fold_segmented(history: DataFrame, spec: FoldSpec, feats: list[str]) -> DataFrame:
    key = spec.key
    kinds = {f.name: f.dataType for f in history.schema.fields}
    segs = _segment_summaries(history, spec, feats)
    by_seg = Window.partitionBy(key).orderBy("_seg")
    segs = segs.withColumns({f"_b_{c}": F.col(f"_f_{c}") - F.lag(f"_e_{c}").over(by_seg)
                             for c in spec.trend})
    # the segment of the highest sequence number; a segment of NULL numbers holds none
    numbered = F.when(F.col("_top").isNotNull(), F.col("_seg"))
    out = []
    for c in feats:
        out += [_mean(F.sum(f"_s_{c}"), F.sum(f"_n_{c}"), kinds[c]).alias(f"{c}_mean"),
                F.max(f"_x_{c}").alias(f"{c}_max"),
                F.max_by(f"_l_{c}", numbered).alias(f"{c}_last")]
    out.append(F.sum("_rows").alias(f"{spec.seq}_cnt"))
    for c in spec.trend:
        step = _step_type(kinds[c])
        border = _sum(F.col(f"_b_{c}"), step)
        inside = F.sum(f"_ds_{c}")
        total = F.coalesce(inside + border, inside, border)
        n = F.sum(f"_dn_{c}") + F.count(f"_b_{c}")
        out.append(F.coalesce(_mean(total, n, step).cast("double"), F.lit(0.0)).alias(f"{c}_trend"))
    for c in spec.recent:
        out.append(F.try_divide(F.max_by(f"_rs_{c}", numbered), F.max_by(f"_rc_{c}", numbered))
                   .alias(f"{c}_recent{spec.recent_n}"))
    return segs.groupBy(key).agg(*out)


def with_steps(history: DataFrame, spec: FoldSpec = FoldSpec(), strategy: str = "auto") -> DataFrame:
    """Row-level extension (P2, W1, W2): every history column plus ``{seq}_max`` (the key's highest
    sequence number) and ``{c}_step`` = c - LAG(c) for the trend columns.

    Same plan choice as the fold. Segmented: LAG runs inside (key, segment); the first row of a segment
    takes the last value of the previous segment from a per-segment table joined null-safe on (key, segment).
    """
    spec.check(history)
    key, seq = spec.key, spec.seq
    if strategy == "auto":
        strategy = choose_strategy(history, spec)
    if strategy == "single":
        w = Window.partitionBy(key).orderBy(seq, *spec.trend)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return history.select(*history.columns, F.max(seq).over(whole).alias(f"{seq}_max"),
                              *[(F.col(c) - F.lag(c).over(w)).alias(f"{c}_step") for c in spec.trend])
    rows = _segmented(history, spec, carry=0)
    w = Window.partitionBy(key, "_seg").orderBy(seq, *spec.trend)
    stepped = rows.withColumns({"_first": F.lag(F.lit(1)).over(w).isNull(), "_last": F.lead(F.lit(1)).over(w).isNull(),
                                **{f"_p_{c}": F.lag(c).over(w) for c in spec.trend}})
    segs = stepped.groupBy(F.col(key).alias("_key"), F.col("_seg").alias("_at")).agg(
        F.max(seq).alias("_smax"), *[F.max(F.when(F.col("_last"), F.col(c))).alias(f"_l_{c}") for c in spec.trend])
    by_seg = Window.partitionBy("_key").orderBy("_at")
    all_segs = by_seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    info = segs.select("_key", "_at", F.max("_smax").over(all_segs).alias(f"{seq}_max"),
                       *[F.lag(f"_l_{c}").over(by_seg).alias(f"_pl_{c}") for c in spec.trend])
    joined = stepped.join(info, F.col(key).eqNullSafe(F.col("_key")) & F.col("_seg").eqNullSafe(F.col("_at")))
    steps = [(F.col(c) - F.when(F.col("_first"), F.col(f"_pl_{c}"))
              .otherwise(F.col(f"_p_{c}"))).alias(f"{c}_step") for c in spec.trend]
    return joined.select(*history.columns, f"{seq}_max", *steps)

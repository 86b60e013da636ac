"""Weight of evidence, information value and monotone binning."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmark.functions.expr import bin_index
from lendmark.functions.scale import iv_rating
from lendmark.functions.state import local_frame, settled
from lendmark.operators.quantiles import even_probs, exact_quantiles, open_edges, sql_array

FEW_CATEGORIES = 100
FREQUENT = 64  # most frequent categories of a feature that are looked up in the projection
MISSING_TEXT = "nan"  # fixed value: the category of missing text
BIN_SCHEMA = (
    "feature string, kind string, bin_id int, lower double, upper double, category string, "
    "label string, total bigint, goods bigint, bads bigint, all_goods bigint, all_bads bigint"
)
BIN_COLUMNS = [
    "feature", "kind", "bin_id", "lower", "upper", "category", "label",
    "total", "goods", "bads", "pct_goods", "pct_bads", "woe", "iv_contrib",
]


@dataclass(frozen=True)
class WoeModel:
    """Fitted bins. ``edges`` and ``numeric_woe`` have features x bins entries;
    ``bins`` is the tidy table, also holding the categorical features."""

    features: list[str]
    edges: dict[str, list[float]]
    numeric_woe: dict[str, list[float]]
    category_woe: dict[str, dict[str, float]]  # features with few categories only
    bins: DataFrame
    rows: int = 0  # rows with a target that the bins were fitted on
    distributed: bool = False  # ``bins`` is too large to be a local relation

    @property
    def categorical(self) -> list[str]:
        return [f for f in self.features if f not in self.edges]


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def category_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(MISSING_TEXT))


# ------------------------------------------------------------------- edges


def padded_edges(quantiles: Sequence[float] | None) -> list[float]:
    """Distinct edges with finite ends moved out by 1e-5 (values beyond have no bin)."""
    edges = sorted(set(quantiles or ()))
    if len(edges) < 2:
        value = edges[0] if edges else 0.0
        edges = [value, value]
    return [edges[0] - 1e-5, *edges[1:-1], edges[-1] + 1e-5]


def merge_monotone(
    edges: Sequence[float], counts: Sequence[tuple[int, int, int]], tol: float = 1e-4
) -> tuple[list[float], list[tuple[int, int, int]]]:
    """Merge neighbouring bins until the bad rate is monotone.

    ``counts`` holds (total, goods, bads) per bin; merging adds them up, so the
    data is never read again. Each round: an empty bin (other than the first)
    joins its left neighbour; else stop when rates rise or fall throughout
    within ``tol`` or two bins are left; else the pair with the smallest
    absolute step is merged. An empty first bin has no rate: its step wins.
    """
    edges, counts = list(edges), list(counts)
    while True:  # every round takes one bin away
        rates = [(c[2] / c[0] if c[0] else None) for c in counts]
        gap = next((i for i, r in enumerate(rates) if r is None), None)
        if gap:
            cut = gap
        else:
            if len(counts) <= 2:
                break
            steps = [None if a is None or b is None else b - a for a, b in zip(rates, rates[1:])]
            known = [s for s in steps if s is not None]
            rising = len(known) == len(steps) and all(s >= -tol for s in known)
            falling = len(known) == len(steps) and all(s <= tol for s in known)
            if rising or falling:
                break
            cut = 1 + (steps.index(None) if None in steps else steps.index(min(steps, key=abs)))
        merged = tuple(a + b for a, b in zip(counts[cut - 1], counts[cut]))
        edges.pop(cut)
        counts[cut - 1 : cut + 1] = [merged]
    return edges, counts


# ------------------------------------------------------------------ counts


def bin_counts(
    df: DataFrame, edges: Mapping[str, Sequence[float]], categorical: Sequence[str], target: str
) -> DataFrame:
    """(feature, bin, total, goods, bads) of all features in one pass.

    ``bin`` is the bin number or the category as text; null for a numeric
    value without a bin. Rows are combined per task before the shuffle, so the
    few large groups cost nothing.
    """
    keys = [(f, bin_index(f, e).cast("string")) for f, e in edges.items()]
    keys += [(f, category_text(F.col(f))) for f in categorical]
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), key.alias("bin")) for f, key in keys))
    return (
        df.select(F.col(target).alias("__y"), F.inline(pairs))
        .groupBy("feature", "bin")
        .agg(
            F.count("__y").alias("total"),
            F.count_if(F.col("__y") == 0).alias("goods"),
            F.count_if(F.col("__y") == 1).alias("bads"),
        )
    )


def weigh(counts: DataFrame, smoothing: str = "count") -> DataFrame:
    """WoE and IV columns from (feature, goods, bads, all_goods, all_bads).

    ``count``: counts floored at 0.5 after counting. ``share``: shares floored
    at 1e-6. WoE is ln(share of goods / share of bads): higher is safer.
    """
    all_goods = F.greatest(F.col("all_goods"), F.lit(1)).cast("double")
    all_bads = F.greatest(F.col("all_bads"), F.lit(1)).cast("double")
    floor = F.lit(0.5 if smoothing == "count" else 0.0)
    good_share = F.greatest(F.col("goods").cast("double"), floor) / all_goods
    bad_share = F.greatest(F.col("bads").cast("double"), floor) / all_bads
    if smoothing == "share":
        good_share, bad_share = (F.greatest(s, F.lit(1e-6)) for s in (good_share, bad_share))
    elif smoothing != "count":
        raise ValueError(f"unknown smoothing {smoothing!r}")
    return (
        counts.withColumns({"pct_goods": good_share, "pct_bads": bad_share})
        .withColumn("woe", F.log(F.col("pct_goods") / F.col("pct_bads")))
        .withColumn("iv_contrib", (F.col("pct_goods") - F.col("pct_bads")) * F.col("woe"))
    )


def fit_woe(
    df: DataFrame,
    features: Sequence[str],
    target: str = "target",
    n_bins: int = 5,
    smoothing: str = "count",
    monotone: bool = True,
    edges: Mapping[str, Sequence[float]] | None = None,
) -> WoeModel:
    """Bins and weights of all features: one quantile fit, one counting pass.

    ``smoothing="share"`` with ``monotone=False`` is the variant with finite
    padded end bins and floored shares.
    """
    features = list(features)
    numeric = [f for f in features if is_numeric(df, f)]
    categorical = [f for f in features if f not in numeric]
    if edges is None:
        raw = exact_quantiles(df, {f: even_probs(n_bins) for f in numeric}) if numeric else {}
        make = open_edges if smoothing == "count" else padded_edges
        edges = {f: make(raw[f]) for f in numeric}
    edges = {f: list(e) for f, e in edges.items()}
    counted = bin_counts(df, edges, categorical, target)
    counts, small = settled(counted)
    tallies = counts if small else counts.filter(F.col("feature").isin(*numeric))
    # all rows when there are few, otherwise the numeric ones: features x (bins + 1)
    seen: dict[str, dict] = {f: {} for f in features}
    for row in tallies.collect():
        seen[row["feature"]][row["bin"]] = (row["total"], row["goods"], row["bads"])
    if seen[features[0]]:
        sums = tuple(sum(c[i] for c in seen[features[0]].values()) for i in (1, 2))
    else:
        row = counts.filter(F.col("feature") == features[0]).agg(F.sum("goods"), F.sum("bads")).first()
        sums = (row[0] or 0, row[1] or 0)

    rows, fitted = [], {}
    for f in numeric:
        per_bin = [seen[f].get(str(i), (0, 0, 0)) for i in range(len(edges[f]) - 1)]
        fitted[f], per_bin = merge_monotone(edges[f], per_bin) if monotone else (edges[f], per_bin)
        for i, tally in enumerate(per_bin):
            lower, upper = fitted[f][i], fitted[f][i + 1]
            rows.append((f, "numeric", i, lower, upper, None, f"({lower:.2f}, {upper:.2f}]", *tally, *sums))
    for f in categorical:
        rows += [(f, "categorical", None, None, None, c, c, *tally, *sums) for c, tally in sorted(seen[f].items())]
    bins = local_frame(df.sparkSession, rows, BIN_SCHEMA)
    if not small and categorical:
        named = counts.filter(F.col("feature").isin(*categorical)).select(
            "feature",
            F.lit("categorical").alias("kind"),
            F.lit(None).cast("int").alias("bin_id"),
            F.lit(None).cast("double").alias("lower"),
            F.lit(None).cast("double").alias("upper"),
            F.col("bin").alias("category"),
            F.col("bin").alias("label"),
            "total",
            "goods",
            "bads",
            *(F.lit(s).cast("bigint").alias(c) for s, c in zip(sums, ("all_goods", "all_bads"))),
        )
        bins = bins.unionByName(named)
    table = weigh(bins, smoothing).select(*BIN_COLUMNS)
    weights: dict[str, list[float]] = {f: [0.0] * (len(e) - 1) for f, e in fitted.items()}
    for row in table.filter("kind = 'numeric'").select("feature", "bin_id", "woe").collect():
        weights[row["feature"]][row["bin_id"]] = row["woe"]
    levels: dict[str, dict[str, float]] = {}
    if small:
        for row in table.filter("kind = 'categorical'").select("feature", "category", "woe").collect():
            levels.setdefault(row["feature"], {})[row["category"]] = row["woe"]
    few = {f: v for f, v in levels.items() if len(v) <= FEW_CATEGORIES}
    return WoeModel(features, fitted, weights, few, table, sum(sums), not small)


# --------------------------------------------------------------- summaries


def information_value(bins: DataFrame) -> DataFrame:
    return bins.groupBy("feature").agg(F.sum("iv_contrib").alias("information_value"))


def iv_summary(bins: DataFrame) -> DataFrame:
    """(feature, information_value, strength_rating), strongest first; rated before rounding."""
    return (
        information_value(bins)
        .select(
            "feature",
            F.round("information_value", 4).alias("information_value"),
            iv_rating(F.col("information_value")).alias("strength_rating"),
        )
        .orderBy(F.desc("information_value"), "feature")
    )


def iv_screen(summary: DataFrame, min_iv: float = 0.02) -> DataFrame:
    return summary.filter(F.col("information_value") >= min_iv)


# --------------------------------------------------------------- transform


def map_bins(
    df: DataFrame,
    model: WoeModel,
    numeric: Mapping[str, Sequence[float]],
    few: Mapping[str, Mapping[str, float]],
    table: DataFrame,
    suffix: str,
    missing: float = 0.0,
) -> DataFrame:
    """Add ``<feature><suffix>``: a value per bin. Absent features are skipped.

    Numeric features compare against literal edges, categorical ones with few
    categories look up a literal map, all in one projection. Other categorical
    features join the (feature, category, value) rows of ``table``. Where that is
    too large to be sent to all tasks, a pass over ``df`` finds the ``FREQUENT``
    most frequent categories first: these are looked up in the projection too, and
    their rows are spread, so that no category fills a task of the join. Values
    without a bin get ``missing``.
    """
    added, joined = {}, []
    for f in model.features:
        if f not in df.columns:
            continue
        if f in model.edges:
            index = bin_index(f, model.edges[f])
            added[f + suffix] = F.coalesce(F.get(sql_array(numeric[f]), index), F.lit(missing))
        elif few.get(f):
            found = F.try_element_at(_literal_map(few[f]), category_text(F.col(f)))
            added[f + suffix] = F.coalesce(found, F.lit(missing))
        else:
            joined.append(f)
    out = df.withColumns(added) if added else df
    for f in joined:
        named = table.filter(F.col("feature") == f).select(
            F.col("category").alias("__category"), F.col("value").alias("__value")
        )
        heavy = frequent(df, f) if model.distributed else []
        out = _looked_up(out, f, named, [*{*heavy, MISSING_TEXT}], suffix, missing)
    return out


def _literal_map(values: Mapping[str, float | None]) -> Column:
    return F.create_map(*(x if isinstance(x, Column) else F.lit(x) for pair in values.items() for x in pair))


def frequent(df: DataFrame, feature: str, most: int = FREQUENT) -> list[str]:
    """The ``most`` frequent categories; any other has less than one in ``most`` rows. Counted before the shuffle."""
    counts = df.groupBy(category_text(F.col(feature)).alias("c")).agg(F.count("*").alias("n"))
    return [r["c"] for r in counts.orderBy(F.desc("n"), "c").limit(most).collect()]


def spread_key(df: DataFrame, feature: str, heavy: Sequence[str]) -> Column:
    """The join key of a feature: rows of ``heavy`` categories get one of many keys that match nothing."""
    text = category_text(F.col(feature))
    salt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(1 << 20)).cast("string")
    return F.when(text.isin(*heavy), F.concat(F.lit("\0"), salt)).otherwise(text)


def _looked_up(
    df: DataFrame, feature: str, named: DataFrame, heavy: Sequence[str], suffix: str, missing: float
) -> DataFrame:
    """Add a categorical feature's value: of ``heavy`` categories by a literal map, of the others by a join."""
    known = {r["__category"]: r["__value"] for r in named.filter(F.col("__category").isin(*heavy)).collect()}
    literal = F.try_element_at(_literal_map(known), category_text(F.col(feature))) if known else F.lit(None)
    value = F.coalesce(literal.cast("double"), F.col("__value").cast("double"), F.lit(missing))
    return (
        df.withColumn("__key", spread_key(df, feature, heavy))
        .join(named, F.col("__key") == F.col("__category"), "left")
        .withColumn(feature + suffix, value)
        .drop("__key", "__category", "__value")
    )


def apply_woe(df: DataFrame, model: WoeModel) -> DataFrame:
    """Add ``<feature>_woe``; null and unseen values get the neutral 0.0."""
    table = model.bins.filter("kind = 'categorical'").select("feature", "category", F.col("woe").alias("value"))
    return map_bins(df, model, model.numeric_woe, model.category_woe, table, "_woe")


def woe_columns(model: WoeModel) -> list[str]:
    return [f + "_woe" for f in model.features]


def edges_frame(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, edge_id, lower, upper) of fitted edges, null for an infinite end."""
    finite = [[None if math.isinf(x) else x for x in e] for e in edges.values()]
    rows = [(f, i, e[i], e[i + 1]) for f, e in zip(edges, finite) for i in range(len(e) - 1)]
    return local_frame(df.sparkSession, rows, "feature string, edge_id int, lower double, upper double")

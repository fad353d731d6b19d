"""Cleaning, sampling, scaling and profiles of labelled flow tables."""

from pyspark.sql import functions as F

from .. import views
from ..operators import cleaning, sampling, scaling
from ..plans import eda
from ..schemas import BOX_FEATURES, CLASS_IDS, FEATURES, MEDIAN_FEATURES, RAW_LABEL_GROUPS, VIOLIN_FEATURES

LAB = f"lab AS ({views.LABELLED_SQL})"
RAW = f"raw AS ({views.RAW_SQL})"
KEYS = ", ".join(views.ROW_KEYS)
SCATTER = "(l_orderkey * 2654435761 + l_partkey * 40503 + l_linenumber * 97) % 4294967296"
ORDER = ["_scatter", *views.ROW_KEYS]
ORDER_SQL = f"{SCATTER}, {KEYS}"
GROUPED = "CASE \"Label\" " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in RAW_LABEL_GROUPS.items()) + ' ELSE "Label" END'
CLASS_SQL = 'CASE "Attack Type" ' + " ".join(f"WHEN '{a}' THEN {b}" for a, b in CLASS_IDS.items()) + " END"
CLEAN = f"""{RAW}, inf AS (SELECT "Flow Duration", CASE WHEN isinf("Flow Bytes/s") THEN NULL ELSE "Flow Bytes/s" END AS "Flow Bytes/s",
  "Flow Packets/s", "ACK Flag Count", {GROUPED} AS "Attack Type" FROM raw),
ok AS (SELECT * FROM inf WHERE "Flow Bytes/s" IS NOT NULL AND NOT isnan("Flow Packets/s"))"""


def lab(spark, folder):
    return views.labelled(spark, folder)


def ordered(spark, folder):
    return lab(spark, folder).withColumn("_scatter", F.expr(SCATTER))


def raw(spark, folder):
    return cleaning.regroup_labels(cleaning.strip_columns(views.raw_flows(spark, folder)))


def strip_names(spark, folder):
    return cleaning.strip_columns(views.raw_flows(spark, folder)).groupBy("Label").agg(
        F.sum("Flow Duration").alias("total"), F.count("*").alias("n"))


def regroup(spark, folder):
    return raw(spark, folder).groupBy("Attack Type").agg(F.count("*").alias("n"))


def infinite_to_null(spark, folder):
    return cleaning.inf_to_null(raw(spark, folder)).select("Flow Duration", "Flow Bytes/s", "Attack Type")


def incomplete_dropped(spark, folder):
    return cleaning.drop_incomplete(cleaning.inf_to_null(raw(spark, folder))).select("Flow Duration", "Flow Bytes/s", "Flow Packets/s")


def dedup_rows(spark, folder):
    return cleaning.clean(views.raw_flows(spark, folder))


def dedup_first(spark, folder):
    """Copies of (quantity, discount, tax); the lowest order key is kept."""
    items = views.table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_orderkey")
    return cleaning.dedup(items, order="l_orderkey")


def clean_report(spark, folder):
    return cleaning.clean_report(raw(spark, folder))


def encode(spark, folder):
    return cleaning.encode_labels(lab(spark, folder)).select(*views.ROW_KEYS, "Attack Type")


def coerce(spark, folder):
    named = cleaning.coerce_label(lab(spark, folder)).groupBy("Attack Type").agg(F.count("*").alias("named"))
    numbered = cleaning.coerce_label(cleaning.encode_labels(lab(spark, folder))).groupBy("Attack Type").agg(F.count("*").alias("numbered"))
    return named.join(numbered, "Attack Type")


def selected(spark, folder):
    """All twenty features with two of them missing from the input."""
    short = lab(spark, folder).drop("Flow IAT Std", "PSH Flag Count")
    return cleaning.select_features(short, keep=views.ROW_KEYS)


def kinds(spark, folder):
    return cleaning.traffic_kind(lab(spark, folder)).groupBy("Traffic").agg(F.count("*").alias("n"))


def per_class(spark, folder):
    return sampling.sample_per_class(ordered(spark, folder), "Attack Type", 500, ORDER).select(*views.ROW_KEYS, "Attack Type")


def chronological(spark, folder):
    train, test = sampling.split_chronological(ordered(spark, folder), ORDER)
    return train.select(*views.ROW_KEYS, F.lit("train").alias("part")).unionByName(
        test.select(*views.ROW_KEYS, F.lit("test").alias("part")))


def stratified(spark, folder):
    train, test = sampling.split_stratified(ordered(spark, folder), "Attack Type", ORDER)
    return train.select(*views.ROW_KEYS, F.lit("train").alias("part")).unionByName(
        test.select(*views.ROW_KEYS, F.lit("test").alias("part")))


def undersampled(spark, folder):
    half = ordered(spark, folder)
    return sampling.undersample(half, "Attack Type", "Normal Traffic", 3000, ORDER).select(*views.ROW_KEYS, "Attack Type")


def imputed(spark, folder):
    found = sampling.impute_median(raw(spark, folder), ["Flow Bytes/s", "Flow Packets/s"])
    return found.select("Flow Duration", F.round("Flow Bytes/s", 8).alias("Flow Bytes/s"), "Flow Packets/s")


def sampled(spark, folder):
    """A repeatable tenth of the rows."""
    place = F.expr(SCATTER) / F.lit(4294967296.0)
    return sampling.sample_fraction(lab(spark, folder), 0.1, place=place).select(*views.ROW_KEYS)


def scaler_fit(spark, folder):
    found = scaling.scaler_stats(lab(spark, folder), FEATURES)
    return found.select("feature", F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"))


def scaled_rows(spark, folder):
    df = lab(spark, folder)
    scaled = scaling.scale_clip(df, scaling.fit_scaler(df, FEATURES))
    return scaled.select(*views.ROW_KEYS, *[(F.floor(F.col(f"`{f}`") * 1e6 + 0.5) / 1e6).alias(f) for f in FEATURES])


def distribution(spark, folder):
    return scaling.class_distribution(views.predictions(spark, folder).withColumn("y", F.expr("y + (l_partkey % 3)")), "y")


def weights(spark, folder):
    return scaling.class_weights(lab(spark, folder), "Attack Type").withColumn("weight", F.round("weight", 8))


def smote_plan(spark, folder):
    return scaling.oversampling_plan(lab(spark, folder), "Attack Type", 3000)


def q(feature, fn):
    return fn.replace("?", f'"{feature}"')


def per_feature(columns, source, *exprs):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, " + ", ".join(q(c, e) for e in exprs) + f" FROM {source}" for c in columns)


def describe(spark, folder):
    return eda.describe_features(lab(spark, folder))


def corr_all(spark, folder):
    return eda.correlations(lab(spark, folder)).withColumn("r", F.round("r", 8))


def corr_high(spark, folder):
    return eda.high_correlations(lab(spark, folder)).withColumn("r", F.round("r", 8))


CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr(\"{a}\", \"{b}\"), 8) AS r FROM lab"
    for a in FEATURES for b in FEATURES)
HIGH_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(\"{a}\", \"{b}\") AS r FROM lab"
    for i, a in enumerate(FEATURES) for b in FEATURES[:i])


def histogram(spark, folder):
    return eda.clipped_histogram(raw(spark, folder), "Flow Bytes/s").withColumn("lower", F.round("lower", 8))


HIST = """, v AS (SELECT "Flow Bytes/s" AS v FROM raw WHERE "Flow Bytes/s" IS NOT NULL AND NOT isinf("Flow Bytes/s")),
b AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM v),
h AS (SELECT least(59, floor((greatest(lo, least(hi, v)) - lo) / ((hi - lo) / 60)))::INT AS bin, count(*) AS n FROM v, b GROUP BY 1)
SELECT r.i::INT AS bin, round(lo + r.i * ((hi - lo) / 60), 8) AS lower, coalesce(n, 0) AS "count"
FROM range(60) r(i) CROSS JOIN b LEFT JOIN h ON h.bin = r.i"""


def boxes(spark, folder):
    return eda.box_stats(lab(spark, folder)).select(
        "Traffic", "feature", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


def quartiles(spark, folder):
    found = eda.class_quartiles(ordered(spark, folder), ORDER)
    return found.select("feature", "label", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "position")


TRAFFIC = "CASE WHEN \"Attack Type\" = 'Normal Traffic' THEN 'Normal' ELSE 'Attack' END"
BOX_SQL = f"""WITH {LAB}, t AS ({' UNION ALL '.join(f"SELECT {TRAFFIC} AS Traffic, '{c}' AS feature, " + f'"{c}" AS v FROM lab' for c in BOX_FEATURES)}),
q AS (SELECT Traffic, feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM t GROUP BY ALL)
SELECT Traffic, feature, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(min(v), 4) AS whisker_low, round(max(v), 4) AS whisker_high
FROM t JOIN q USING (Traffic, feature) WHERE v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 GROUP BY ALL"""
VIOLIN_SQL = f"""WITH {LAB}, s AS (SELECT * FROM lab),
t AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, " + f'"Attack Type" AS label, "{c}" AS v FROM s' for c in VIOLIN_FEATURES)}),
q AS (SELECT feature, label, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM t GROUP BY ALL)
SELECT feature, label, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  row_number() OVER (PARTITION BY feature ORDER BY q.median, label) AS position FROM q"""
MEDIANS_SQL = " UNION ALL ".join(
    f"SELECT \"Attack Type\" AS label, '{c}' AS feature, round(quantile_cont(\"{c}\", 0.5), 2) AS median FROM lab GROUP BY 1" for c in MEDIAN_FEATURES)
SPLIT = "CASE WHEN rn <= {k} THEN 'train' ELSE 'test' END AS part"
STRATA = f"""WITH {LAB}, c AS (SELECT "Attack Type" AS l, count(*) AS n FROM lab GROUP BY 1),
t AS (SELECT sum(n) AS m, (sum(n) - ceil(sum(n) * 0.2))::BIGINT AS tr FROM c),
e AS (SELECT l, n * tr / m AS x, floor(n * tr / m)::BIGINT AS fl, tr FROM c, t),
r AS (SELECT *, row_number() OVER (ORDER BY fl - x, l) AS k, tr - sum(fl) OVER () AS left_over FROM e),
s AS (SELECT l, fl + CASE WHEN k <= left_over THEN 1 ELSE 0 END AS keep FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY "Attack Type" ORDER BY {ORDER_SQL}) AS rn FROM lab)
SELECT {KEYS}, CASE WHEN rn <= keep THEN 'train' ELSE 'test' END AS part FROM o JOIN s ON o."Attack Type" = s.l"""
STATS = ("avg(?) AS m", "stddev_samp(?) AS s")

QUERIES = {
    "strip_columns": (strip_names, f'WITH {RAW} SELECT "Label", sum("Flow Duration") AS total, count(*) AS n FROM raw GROUP BY 1'),
    "regroup_labels": (regroup, f'WITH {RAW} SELECT {GROUPED} AS "Attack Type", count(*) AS n FROM raw GROUP BY 1'),
    "inf_to_null": (infinite_to_null, f'WITH {CLEAN} SELECT "Flow Duration", "Flow Bytes/s", "Attack Type" FROM inf'),
    "drop_incomplete": (incomplete_dropped, f'WITH {CLEAN} SELECT "Flow Duration", "Flow Bytes/s", "Flow Packets/s" FROM ok'),
    "dedup": (dedup_rows, f"WITH {CLEAN} SELECT DISTINCT * FROM ok"),
    "dedup_keep_first": (dedup_first, "SELECT l_quantity, l_discount, l_tax, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1, 2, 3"),
    "clean_report": (clean_report, f"""WITH {CLEAN}, c AS (SELECT (SELECT count(*) FROM inf) AS a, (SELECT count(*) FROM ok) AS b,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM ok)) AS c) SELECT a AS rows_in, a - b AS incomplete, b - c AS duplicates, c AS rows_out FROM c"""),
    "label_counts": (lambda s, f: cleaning.label_counts(lab(s, f)), f'WITH {LAB} SELECT "Attack Type" AS label, count(*) AS "count" FROM lab GROUP BY 1'),
    "encode_labels": (encode, f'WITH {LAB} SELECT {KEYS}, {CLASS_SQL} AS "Attack Type" FROM lab WHERE ({CLASS_SQL}) IS NOT NULL'),
    "unknown_labels": (lambda s, f: cleaning.unknown_labels(lab(s, f)),
                       f'WITH {LAB} SELECT "Attack Type" AS label, count(*) AS "count" FROM lab WHERE ({CLASS_SQL}) IS NULL GROUP BY 1'),
    "coerce_label": (coerce, f'WITH {LAB} SELECT {CLASS_SQL} AS "Attack Type", count(*) AS named, count(*) AS numbered FROM lab WHERE ({CLASS_SQL}) IS NOT NULL GROUP BY 1'),
    "select_features": (selected, f"WITH {LAB} SELECT {KEYS}, " + ", ".join(
        f'0.0::DOUBLE AS "{c}"' if c in ("Flow IAT Std", "PSH Flag Count") else f'"{c}"' for c in FEATURES) + " FROM lab"),
    "traffic_kind": (kinds, f"WITH {LAB} SELECT {TRAFFIC} AS Traffic, count(*) AS n FROM lab GROUP BY 1"),
    "sample_fraction": (sampled, f"WITH {LAB} SELECT {KEYS} FROM lab WHERE ({SCATTER}) / 4294967296.0::DOUBLE < 0.1"),
    "sample_per_class": (per_class, f"""WITH {LAB} SELECT {KEYS}, "Attack Type" FROM (SELECT *, row_number() OVER (PARTITION BY "Attack Type" ORDER BY {ORDER_SQL}) AS rn FROM lab) WHERE rn <= 500"""),
    "undersample": (undersampled, f"""WITH {LAB} SELECT {KEYS}, "Attack Type" FROM (SELECT *, row_number() OVER (PARTITION BY "Attack Type" ORDER BY {ORDER_SQL}) AS rn FROM lab)
       WHERE "Attack Type" <> 'Normal Traffic' OR rn <= 3000"""),
    "impute_median": (imputed, f"""WITH {RAW}, i AS (SELECT "Flow Duration", CASE WHEN isinf("Flow Bytes/s") THEN NULL ELSE "Flow Bytes/s" END AS b,
       CASE WHEN isnan("Flow Packets/s") THEN NULL ELSE "Flow Packets/s" END AS p FROM raw)
       SELECT "Flow Duration", round(coalesce(b, (SELECT quantile_cont(b, 0.5) FROM i)), 8) AS "Flow Bytes/s", coalesce(p, (SELECT quantile_cont(p, 0.5) FROM i)) AS "Flow Packets/s" FROM i"""),
    "split_chronological": (chronological, f"""WITH {LAB}, o AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) AS rn, count(*) OVER () AS n FROM lab)
       SELECT {KEYS}, CASE WHEN rn <= floor(n * (1.0::DOUBLE - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM o"""),
    "split_stratified": (stratified, STRATA),
    "fit_scaler": (scaler_fit, f"WITH {LAB} " + per_feature(FEATURES, "lab", "round(avg(?), 3) AS mean", "round(CASE WHEN stddev_pop(?) > 0 THEN stddev_pop(?) ELSE 1 END, 3) AS std")),
    "scale_clip": (scaled_rows, f"WITH {LAB}, s AS (SELECT " + ", ".join(
        f'avg("{c}") AS m{i}, stddev_pop("{c}") AS s{i}' for i, c in enumerate(FEATURES)) + f" FROM lab) SELECT {KEYS}, " + ", ".join(
        f'floor(greatest(-5, least(5, ("{c}" - m{i}) / s{i})) * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS "{c}"' for i, c in enumerate(FEATURES)) + " FROM lab, s"),
    "class_distribution": (distribution, f"""SELECT label, CASE label {' '.join(f"WHEN {v} THEN '{k}'" for k, v in CLASS_IDS.items())} ELSE 'UNKNOWN(' || label || ')' END AS name, "count"
       FROM (SELECT y + (l_partkey % 3) AS label, count(*) AS "count" FROM ({views.PREDICTIONS_SQL}) GROUP BY 1)"""),
    "class_weights": (weights, f"""WITH {LAB}, c AS (SELECT "Attack Type" AS label, count(*) AS n FROM lab GROUP BY 1)
       SELECT label, round(sum(n) OVER () / (count(*) OVER () * n), 8) AS weight FROM c"""),
    "oversampling_plan": (smote_plan, f"""WITH {LAB}, c AS (SELECT "Attack Type" AS label, count(*) AS have FROM lab GROUP BY 1)
       SELECT label, have, CASE WHEN have >= 3001 THEN max(have) OVER () ELSE have END AS want, have >= 3001 AS eligible FROM c"""),
    "overview": (lambda s, f: eda.overview(lab(s, f)), f'WITH {LAB} SELECT count(*) AS "rows", 25 AS "columns", 24 AS numeric_columns, 1 AS other_columns, count(DISTINCT "Attack Type") AS classes FROM lab'),
    "type_counts": (lambda s, f: eda.type_counts(lab(s, f)), f"""WITH {LAB} SELECT t AS "type", k AS "columns", k * n AS filled
       FROM (VALUES ('bigint', 3), ('int', 1), ('double', 20), ('string', 1)) v(t, k), (SELECT count(*) AS n FROM lab)"""),
    "describe_features": (describe, f"WITH {LAB} " + per_feature(FEATURES, "lab", "round(avg(?), 2) AS mean", "round(stddev_samp(?), 2) AS std",
       "round(min(?), 2) AS min", "round(quantile_cont(?, 0.5), 2) AS median", "round(max(?), 2) AS max")),
    "class_share": (lambda s, f: eda.class_share(lab(s, f)), f"""WITH {LAB}, c AS (SELECT "Attack Type" AS label, count(*) AS n FROM lab GROUP BY 1)
       SELECT label, n AS "count", round(n / sum(n) OVER () * 100, 2) AS pct, round(n / min(n) OVER (), 1) AS ratio FROM c"""),
    "imbalance": (lambda s, f: eda.imbalance(lab(s, f)).select(F.round("imbalance", 8).alias("imbalance")),
                  f'WITH {LAB}, c AS (SELECT count(*) AS n FROM lab GROUP BY "Attack Type") SELECT round(max(n) / min(n), 8) AS imbalance FROM c'),
    "quality_audit": (lambda s, f: eda.quality_audit(raw(s, f)), f"""WITH {RAW}, d AS (SELECT count(*) AS k FROM (SELECT DISTINCT * EXCLUDE ("Label"), {GROUPED} AS g FROM raw))
       SELECT count(*) FILTER ("Flow Bytes/s" IS NULL) + count(*) FILTER (isnan("Flow Packets/s")) AS missing, count(*) FILTER (isinf("Flow Bytes/s")) AS infinite,
       count(*) - any_value(k) AS duplicates, round((count(*) - any_value(k)) / count(*) * 100, 3) AS duplicate_pct FROM raw, d"""),
    "outlier_rates": (lambda s, f: eda.outlier_rates(lab(s, f), sigmas=2.0).withColumn("rate", F.round("rate", 8)),
                      f"WITH {LAB}, r AS (" + " UNION ALL ".join(
                          f"SELECT '{c}' AS feature, round(avg(CASE WHEN abs((\"{c}\" - m) / s) > 2 THEN 1.0 ELSE 0.0 END), 8) AS rate FROM lab, (SELECT avg(\"{c}\") AS m, stddev_samp(\"{c}\") AS s FROM lab)"
                          for c in FEATURES) + ") SELECT * FROM r WHERE rate > 0 ORDER BY rate DESC, feature LIMIT 15"),
    "clipped_histogram": (histogram, f"WITH {RAW}{HIST}"),
    "class_medians": (lambda s, f: eda.class_medians(lab(s, f)), f"WITH {LAB} {MEDIANS_SQL}"),
    "scaled_medians": (lambda s, f: eda.scaled_medians(lab(s, f)).withColumn("scaled", F.round("scaled", 6)), f"""WITH {LAB}, m AS ({MEDIANS_SQL})
       SELECT *, round((median - min(median) OVER (PARTITION BY feature)) / (max(median) OVER (PARTITION BY feature) - min(median) OVER (PARTITION BY feature) + 1e-9), 6) AS scaled FROM m"""),
    "correlations": (corr_all, f"WITH {LAB} {CORR_SQL}"),
    "high_correlations": (corr_high, f"WITH {LAB}, c AS ({HIGH_SQL}) SELECT feature_a, feature_b, round(r, 8) AS r FROM c WHERE abs(r) > 0.9"),
    "box_stats": (boxes, BOX_SQL),
    "class_quartiles": (quartiles, VIOLIN_SQL),
}

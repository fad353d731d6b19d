"""Evaluation of scored rows."""

from pyspark.sql import functions as F

from .. import views
from ..plans import evaluate
from ..schemas import CLASS_IDS


def pred(spark, folder):
    return views.predictions(spark, folder)


def rounded(df, *columns, places=8):
    return df.select(*[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns])


NAME = "CASE class " + " ".join(f"WHEN {v} THEN '{k}'" for k, v in CLASS_IDS.items()) + " END"
PRED = f"pr AS ({views.PREDICTIONS_SQL})"
REPORT = f"""{PRED}, cl AS (SELECT DISTINCT y AS class FROM pr UNION SELECT DISTINCT p FROM pr),
rep AS (SELECT class, (SELECT count(*) FROM pr WHERE y = class) AS support, (SELECT count(*) FROM pr WHERE p = class) AS guessed,
  (SELECT count(*) FROM pr WHERE y = class AND p = class) AS hits FROM cl),
sc AS (SELECT class, support, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS precision, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
  CASE WHEN support + guessed > 0 THEN 2.0 * hits / (support + guessed) ELSE 0 END AS f1 FROM rep),
met AS (SELECT (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FROM pr) AS accuracy, (SELECT avg(f1) FROM sc) AS macro_f1,
  (SELECT sum(f1 * support) / sum(support) FROM sc) AS weighted_f1, (SELECT avg(CASE WHEN p <> 0 THEN 1.0 ELSE 0.0 END) FROM pr WHERE y = 0) AS fpr_benign)"""
METRICS_ROW = "round(accuracy, 8) AS accuracy, round(macro_f1, 8) AS macro_f1, round(weighted_f1, 8) AS weighted_f1, round(fpr_benign, 8) AS fpr_benign"
CELLS = f"""{PRED}, ex AS (SELECT y, unnest(scores) AS score, unnest(range(7)) AS class FROM pr),
ce AS (SELECT class, score, count(*) FILTER (y = class) AS pos, count(*) FILTER (y <> class) AS neg FROM ex WHERE class IN (SELECT DISTINCT y FROM pr) GROUP BY 1, 2),
ru AS (SELECT *, sum(pos) OVER w AS up, sum(neg) OVER w AS un, sum(pos) OVER (PARTITION BY class) AS ap, sum(neg) OVER (PARTITION BY class) AS an
  FROM ce WINDOW w AS (PARTITION BY class ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
auc AS (SELECT class, sum(neg * (up - pos / 2.0)) / (any_value(ap)::DOUBLE * any_value(an)) AS auc FROM ru GROUP BY 1)"""


def compare(spark, folder):
    scored = pred(spark, folder)
    second = scored.withColumn("p", F.expr("case when l_linenumber % 4 = 0 then 0 else y end"))
    found = evaluate.compare_models({"first": scored, "second": second})
    return rounded(found, "accuracy", "macro_f1", "weighted_f1", "fpr_benign")


def roc(spark, folder):
    found = evaluate.roc_points(pred(spark, folder))
    score = F.when(F.col("score") < float("inf"), F.round("score", 8)).otherwise(F.col("score"))
    return rounded(found.withColumn("score", score), "fpr", "tpr")


def metrics_sql(name: str, guess: str) -> str:
    body = REPORT.replace(PRED, f"pr AS (SELECT * REPLACE ({guess} AS p) FROM ({views.PREDICTIONS_SQL}))")
    return f"(WITH {body} SELECT '{name}' AS model, {METRICS_ROW} FROM met)"


QUERIES = {
    "metrics": (lambda s, f: rounded(evaluate.metrics(pred(s, f)), "accuracy", "macro_f1", "weighted_f1", "fpr_benign"),
                f"WITH {REPORT} SELECT {METRICS_ROW} FROM met"),
    "class_report": (lambda s, f: rounded(evaluate.class_report(pred(s, f)), "precision", "recall", "f1"),
                     f"WITH {REPORT} SELECT class, {NAME} AS name, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM sc"),
    "report_averages": (lambda s, f: rounded(evaluate.report_averages(pred(s, f)), "precision", "recall", "f1"), f"""WITH {REPORT}
       SELECT 'macro' AS average, round(avg(precision), 8) AS precision, round(avg(recall), 8) AS recall, round(avg(f1), 8) AS f1, sum(support) AS support FROM sc
       UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8), round(sum(f1 * support) / sum(support), 8), sum(support) FROM sc"""),
    "benign_fpr": (lambda s, f: rounded(evaluate.benign_fpr(pred(s, f)), "fpr_benign"), f"WITH {REPORT} SELECT round(fpr_benign, 8) AS fpr_benign FROM met"),
    "confusion": (lambda s, f: evaluate.confusion(pred(s, f)), f"""WITH {PRED}, l AS (SELECT DISTINCT y AS class FROM pr)
       SELECT a.class AS y, {NAME.replace('class', 'a.class')} AS name, b.class AS p, (SELECT count(*) FROM pr WHERE pr.y = a.class AND pr.p = b.class) AS value FROM l a, l b"""),
    "confusion_normalized": (lambda s, f: rounded(evaluate.confusion(pred(s, f), normalize=True), "value"), f"""WITH {PRED}, l AS (SELECT DISTINCT y AS class FROM pr),
       g AS (SELECT a.class AS y, {NAME.replace('class', 'a.class')} AS name, b.class AS p, (SELECT count(*) FROM pr WHERE pr.y = a.class AND pr.p = b.class) AS n FROM l a, l b)
       SELECT y, name, p, round(n / greatest(sum(n) OVER (PARTITION BY y), 1), 8) AS value FROM g"""),
    "roc_points": (roc,
                   f"WITH {CELLS} SELECT class, round(score, 8) AS score, round(un / an, 8) AS fpr, round(up / ap, 8) AS tpr FROM ru "
                   "UNION ALL SELECT DISTINCT class, CAST('Infinity' AS DOUBLE), 0.0, 0.0 FROM ru"),
    "auc_per_class": (lambda s, f: rounded(evaluate.auc_per_class(pred(s, f)), "auc"), f"WITH {CELLS} SELECT class, {NAME} AS name, round(auc, 8) AS auc FROM auc"),
    "mean_auc": (lambda s, f: rounded(evaluate.mean_auc(pred(s, f)), "mean_auc"), f"WITH {CELLS} SELECT round(avg(auc), 8) AS mean_auc FROM auc"),
    "compare_models": (compare, metrics_sql("first", "p") + " UNION ALL " + metrics_sql("second", "CASE WHEN l_linenumber % 4 = 0 THEN 0 ELSE y END")),
    "evaluation_summary": (lambda s, f: rounded(evaluate.summary(pred(s, f)), "accuracy", "macro_f1", "weighted_f1", "fpr_benign", "mean_auc"),
                           f"WITH {REPORT}, {CELLS.replace(PRED + ', ', '')}, m AS (SELECT avg(auc) AS a FROM auc) SELECT {METRICS_ROW}, round(a, 8) AS mean_auc FROM met, m"),
}

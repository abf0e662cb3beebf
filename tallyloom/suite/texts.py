"""Queries of token counts and TF-IDF weights."""

from pyspark.sql import functions as F

from tallyloom.functions.arrays import LONG_WORD, split_list, with_bigrams, words
from tallyloom.functions.numeric import round_even
from tallyloom.operators import categories, sequence, text, usage
from tallyloom.operators.hot import spread
from tallyloom.suite.cleaning import SPEND_CUTS
from tallyloom.suite.registry import query, rounded, with_parts


def _tfidf_sql(rows: str, n_docs: str, min_df: str, *parts, **extra) -> str:
    """`rows` yields (doc, token), one per occurrence."""
    return with_parts(
        f"""SELECT doc, token, {rounded("w / sqrt(sum(w * w) OVER (PARTITION BY doc))", 6)} AS weight
        FROM (SELECT doc, token, tf * (ln((1.0::DOUBLE + {n_docs}) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS w
          FROM counts JOIN kept USING (token))""",
        *parts,
        **extra,
        counts=f"SELECT doc, token, count(*) AS tf FROM ({rows}) GROUP BY doc, token",
        kept=f"SELECT token, count(*) AS df FROM counts GROUP BY token HAVING count(*) >= {min_df}",
    )


def _six(weights):
    return weights.withColumn("weight", round_even(F.col("weight"), 6))


@query(
    "tfidf_installed",
    _tfidf_sql(
        "SELECT uid AS doc, app AS token FROM installed",
        "(SELECT count(DISTINCT uid) FROM installed)",
        "0.0008 * (SELECT count(DISTINCT uid) FROM installed)",
        "installed",
    ),
)
def tfidf_installed(r):
    docs = r.raw_lists().withColumnRenamed("uid", "doc")
    return _six(text.tfidf(docs, split_list(F.col("apps")), 0.0008))


_copies = f"""SELECT uid AS doc, app AS token, unnest(range(
    CASE WHEN duration < {SPEND_CUTS[0]} THEN 1 WHEN duration < {SPEND_CUTS[1]} THEN 2
    WHEN duration < {SPEND_CUTS[2]} THEN 3 ELSE 4 END)) AS copy FROM app_totals"""


@query(
    "tfidf_usage",
    _tfidf_sql(
        _copies,
        "(SELECT count(DISTINCT uid) FROM app_totals)",
        "0.001 * (SELECT count(DISTINCT uid) FROM app_totals)",
        "app_totals",
    ),
)
def tfidf_usage(r):
    rows = sequence.replicate(usage.app_totals(r.spread_usage("uid", "app")), SPEND_CUTS)
    docs = rows.select(F.col("uid").alias("doc"), F.col("app").alias("token"))
    return _six(text.tfidf_rows(docs, 0.001))


@query(
    "tfidf_category",
    _tfidf_sql(
        "SELECT uid AS doc, category AS token FROM categorised",
        "(SELECT count(DISTINCT uid) FROM categorised)",
        "0",
        "categorised",
    ),
)
def tfidf_category(r):
    rows = categories.with_category(r.usage().select("uid", "app").distinct(), r.categories())
    return _six(text.tfidf_rows(rows.select(F.col("uid").alias("doc"), F.col("category").alias("token")), 0))


_WORD = "[\\p{L}\\p{N}_]+"
_tokens = f"SELECT doc_id AS doc, regexp_extract_all(text, '{_WORD}') AS t FROM documents"
_grams = """SELECT doc, unnest(t) AS token FROM tokens UNION ALL
    SELECT doc, a || ' ' || b AS token FROM (SELECT doc, unnest(t[:-2]) AS a, unnest(t[2:]) AS b FROM tokens
    WHERE len(t) > 1)"""


@query(
    "tfidf_bigram",
    _tfidf_sql(
        _grams,
        "(SELECT count(*) FROM documents)",
        "0.0001 * (SELECT count(*) FROM documents)",
        tokens=_tokens,
    ),
)
def tfidf_bigram(r):
    return _six(text.tfidf(r.texts(), with_bigrams(words(F.col("text"))), 0.0001))


@query(
    "count_vector",
    with_parts(
        """SELECT doc, token, tf FROM counts WHERE token IN (SELECT token FROM counts GROUP BY token
        HAVING count(*) >= 0.0001 * (SELECT count(*) FROM documents))""",
        counts="""SELECT doc, token, count(*) AS tf FROM (SELECT doc_id AS doc,
        unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_]{2,}')) AS token FROM documents) GROUP BY doc, token""",
    ),
)
def count_vector(r):
    return text.count_vectors(r.texts(), words(F.col("text"), LONG_WORD), 0.0001).select("doc", "token", "tf")


@query(
    "count_vector_train",
    with_parts(
        """SELECT uid AS doc, app AS token, tf FROM counts
        WHERE app IN (SELECT app FROM counts JOIN labelled USING (uid))""",
        "usage",
        "labelled",
        counts="SELECT uid, app, count(*) AS tf FROM usage GROUP BY uid, app",
    ),
)
def count_vector_train(r):
    """Vocabulary from the labelled users only."""
    log = r.kept("log", lambda: r.usage().select("uid", "app"))
    log = spread(log, ["uid", "app"], log.count())
    rows = log.select(F.col("uid").alias("doc"), F.col("app").alias("token"))
    fit = sequence.only_users(log, r.labelled())
    found = text.count_rows(rows, 1, fit.select(F.col("uid").alias("doc"), F.col("app").alias("token")))
    return found.select("doc", "token", "tf")

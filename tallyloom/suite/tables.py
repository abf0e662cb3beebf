"""Queries that go through the sinks and sources and read their result back."""

from pyspark.sql import functions as F

from tallyloom.functions.numeric import round_even
from tallyloom.operators import assemble, learn
from tallyloom.plans import stacking
from tallyloom.sources import tables
from tallyloom.sources.stage import stage_path
from tallyloom.suite import routing
from tallyloom.suite.learning import CLASSES, WIDTH, _forest
from tallyloom.suite.registry import SQL, query, real, with_parts

_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("csv_with_header", "SELECT * FROM customer")
def csv_with_header(r):
    path = stage_path(r.spark, "csv")
    tables.write_csv(r.table("customer"), path)
    return tables.read_csv(r.spark, path, _CUSTOMER)


@query("csv_without_header", "SELECT * FROM customer")
def csv_without_header(r):
    path = stage_path(r.spark, "csv")
    tables.write_csv(r.table("customer"), path, header=False)
    return tables.read_csv(r.spark, path, _CUSTOMER, header=False)


@query("csv_append", "SELECT r_regionkey, r_name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation")
def csv_append(r):
    path = stage_path(r.spark, "csv")
    tables.write_csv(r.table("region").select("r_regionkey", "r_name"), path)
    tables.append_csv(r.table("nation").select(F.col("n_nationkey").alias("r_regionkey"), F.col("n_name").alias("r_name")), path)
    return tables.read_csv(r.spark, path, "r_regionkey int, r_name string")


@query("parquet_table", "SELECT * FROM part")
def parquet_table(r):
    path = stage_path(r.spark, "table")
    tables.write_table(r.table("part"), path)
    return tables.read_table(r.spark, path)


@query("list_text", with_parts("SELECT uid, app FROM installed", "installed"))
def list_text(r):
    """Lists written as text such as ['a', 'b'] and parsed again."""
    path = stage_path(r.spark, "csv")
    lists = r.installed_lists()
    quoted = F.transform(F.split("apps", "#"), lambda a: F.concat(F.lit("'"), a, F.lit("'")))
    text = F.concat(F.lit("["), F.concat_ws(", ", quoted), F.lit("]")).alias("apps")
    tables.write_csv(lists.select("uid", text), path)
    read = tables.read_csv(r.spark, path, "uid bigint, apps string")
    return tables.read_list_text(read, "apps").select("uid", F.explode("apps").alias("app"))


@query(
    "score_table",
    "SELECT vec_id AS uid, "
    + ", ".join(f"round_even(CAST(embedding[{k + 1}] AS DOUBLE), 6) AS p_{k}" for k in range(WIDTH))
    + " FROM embeddings",
)
def score_table(r):
    """Scores of many classes in a file whose key column is not called uid."""
    path = stage_path(r.spark, "csv")
    scores = F.col("embedding").cast("array<double>").alias("scores")
    rows = r.table("embeddings").select(F.col("vec_id").cast("long").alias("uid"), scores)
    tables.write_scores(rows, path, WIDTH, key="index")
    read = tables.read_scores(r.spark, path, WIDTH)
    cells = [round_even(F.col("scores").getItem(k), 6).alias(f"p_{k}") for k in range(WIDTH)]
    return read.select("uid", *cells)


_numbers = ["boot_times", "a_times", "f_sum"]


@query(
    "vector_block",
    with_parts(
        " UNION ALL ".join(
            f"SELECT uid, CAST({i} AS BIGINT) AS slot, {real(c)} AS value FROM attributes WHERE {c} <> 0"
            for i, c in enumerate(_numbers)
        ),
        "attributes",
    ),
)
def vector_block(r):
    """Feature vectors of both splits written as one block; both parts are read back."""
    path = stage_path(r.spark, "block")
    users = r.attributes()
    split = F.when(F.col("label").isNotNull(), F.lit("train")).otherwise(F.lit("test"))
    rows = users.join(r.labelled(), "uid", "left").withColumn("split", split)
    block = assemble.to_vector(rows, _numbers, keep=("split",)).withColumn("population", F.lit("full"))
    tables.write_block(block, path)
    parts = [tables.read_block(r.spark, path, "full", split) for split in ("train", "test")]
    return assemble.vector_rows(parts[0].unionByName(parts[1]))


@query("saved_models")
def saved_models(r):
    """Fold models saved, loaded again and applied, with their accuracy written as a table."""
    from pyspark.ml.classification import RandomForestClassificationModel

    rows = stacking.folded_vectors(r.vectors(), folds=2)
    folder = stage_path(r.spark, "models")
    paths = learn.save_models(learn.fit_folds(rows, _forest, CLASSES, 2), folder, r.spark)
    loaded = learn.load_models(paths, RandomForestClassificationModel, r.spark)
    accuracy = learn.fold_accuracy(learn.out_of_fold(rows, loaded))
    tables.write_fold_scores(accuracy, f"{folder}/accuracy")
    return tables.read_csv(r.spark, f"{folder}/accuracy", "fold bigint, n bigint, accuracy double")


@query("submission_sink", SQL["route_predictions"])
def submission_sink(r):
    path = stage_path(r.spark, "csv")
    tables.write_csv(routing.route_predictions(r), path)
    return tables.read_csv(r.spark, path, "id bigint, label bigint")

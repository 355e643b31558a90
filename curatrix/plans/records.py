"""Run records of training, evaluation, export and labeling, and the metrics they are made from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import is_finite
from ..functions.strings import SHA256, is_machine_path
from ..operators import findings as f
from ..operators.lineage import best_row, missing_from, same_keys
from ..session import shuffled

#: Columns of a results table and the names of the metrics in a record.
METRICS = {"metrics/precision(B)": "P", "metrics/recall(B)": "R", "metrics/mAP50(B)": "mAP50", "metrics/mAP50-95(B)": "mAP50-95"}
BEST_BY = "metrics/mAP50-95(B)"
#: Fields of a labeling record.
LABELING_FIELDS = ("id", "kind", "created_at", "tool", "checkpoint", "prompt", "backend", "decode_mode", "command", "inputs", "outputs")


#: A line of a results table, whose quoted cells may hold line ends, and a cell in it: quoted, or up to a comma.
LINE, CELL = r'(?:"(?:[^"]|"")*"|[^"\r\n])+', r'(?:^|,)(?:"((?:[^"]|"")*)"|([^,"]*))'


def _cells(line: Column) -> Column:
    """The cells of a line, without the white space around them and the quotes of quoted ones."""
    whole = F.regexp_extract_all(line, F.lit(CELL), F.lit(0))
    bare = F.transform(whole, lambda c: F.btrim(F.regexp_replace(c, "^,", "")))
    return F.transform(bare, lambda c: F.when(c.startswith('"'), F.btrim(F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"')))).otherwise(c))


def results_rows(tables: DataFrame) -> DataFrame:
    """(run, pos, values, problem) from (run, value), the texts of results tables: a row an epoch, and one with pos -1 for a
    table without any. ``problem`` says why a row cannot be used.

    Each table is read by its own header, whatever the order of its columns; of a name that a header repeats the last
    cell counts, cells beyond the header and those that are no numbers are left out.
    """
    whole = tables.select("run", F.regexp_extract_all(F.coalesce("value", F.lit("")), F.lit(LINE), F.lit(0)).alias("lines"))
    epochs = F.when(F.size("lines") > 1, F.slice("lines", 2, F.size("lines")))
    rows = whole.select("run", _cells(F.get("lines", F.lit(0))).alias("names"), F.posexplode_outer(epochs).alias("pos", "line")).withColumn("cells", _cells(F.col("line")))
    pairs = F.arrays_zip(F.slice("names", 1, F.least(F.size("names"), F.size("cells"))), F.col("cells"))
    named = F.filter(F.transform(pairs, lambda p: F.struct(p["0"].alias("name"), p["cells"].try_cast("double").alias("value"))), lambda p: p["name"].isNotNull() & p["value"].isNotNull())
    last = F.filter(named, lambda p, k: ~F.exists(F.slice(named, k + 2, F.size(named)), lambda q: q["name"] == p["name"]))
    bad = F.exists(named, lambda p: ~is_finite(p["value"]))
    problem = F.when(F.col("line").isNull(), "a results table has no epochs").when(bad, "results hold a non-finite value")
    return rows.select("run", F.coalesce("pos", F.lit(-1)).alias("pos"), F.when(problem.isNull(), F.map_from_entries(last)).alias("values"), problem.alias("problem"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """(run, pos, values map<string,double>) of results tables: one row per epoch. ``run`` is the file.

    An infinite or NaN cell raises, and so does a file without an epoch; one without a byte is not seen by Spark's
    readers and gives no run. A file, a line an epoch, is one row at first.
    """
    rows = results_rows(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("run"), "value"))
    values = F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem")).cast("map<string,double>")).otherwise(F.col("values"))
    return rows.select("run", "pos", values.alias("values"))


def training_metrics(results: DataFrame) -> DataFrame:
    """(run, metrics map): of the best epoch, with its number and how many epochs there are. Runs whose first
    row lacks a detection metric raise."""
    results = shuffled(results)
    best = best_row(results.withColumn("by", F.col("values")[BEST_BY]), ["run"], "by", ["pos"])
    first = results.where("pos = 0").select("run", missing_from(list(METRICS), F.map_keys("values")).alias("lacking"))
    counted = best.join(results.groupBy("run").agg(F.count("*").alias("n")), "run").join(first, "run")
    renamed = F.transform_keys(F.map_filter("values", lambda k, _: F.rlike(k, F.lit("^(train|val)/"))), lambda k, _: F.regexp_replace(k, "^(train|val)/", "$1_"))
    epoch = F.floor(F.coalesce(F.col("values")["epoch"], F.lit(0.0)))
    named = F.create_map(*(x for k, name in METRICS.items() for x in (F.lit(name), F.col("values")[k])), F.lit("best_epoch"), epoch.cast("double"), F.lit("epochs_recorded"), F.col("n").cast("double"))
    good = F.when(F.size("lacking") > 0, F.raise_error(F.lit("results lack detection metrics")).cast("map<string,double>")).otherwise(F.map_concat(named, renamed))
    return counted.select("run", good.alias("metrics"))


def record(kind: Column, record_id: Column, created_at: Column, implementation: Column, config: Column, inputs: Column, outputs: Column, metrics: Column) -> Column:
    """A run record as a struct in the contract's order; ``config`` is JSON text, null metrics are left out."""
    return F.struct(F.lit("1.0.0").alias("schema_version"), record_id.alias("id"), kind.alias("stage"), created_at.alias("created_at"), implementation.alias("implementation"), F.parse_json(config).alias("config"), inputs.alias("inputs"), outputs.alias("outputs"), metrics.alias("metrics"))


def artifacts(*items: tuple[str, str, Column]) -> Column:
    """An array of {role, artifact {path, sha256}}."""
    return F.array(*(F.struct(F.lit(role).alias("role"), F.struct(F.lit(path).alias("path"), digest.alias("sha256")).alias("artifact")) for role, path, digest in items))


def evaluation_input_findings(runs: DataFrame) -> DataFrame:
    """From (document, split, sample_count, metric_definitions, metrics, thresholds): what bars an evaluation record."""
    checks = [
        (~F.coalesce(F.col("split").isin("validation", "test"), F.lit(False)), "/config/split", "evaluations run on validation or test items"),
        (~F.coalesce(F.col("sample_count") >= 1, F.lit(False)), "/config/sample_count", "at least one sample is needed"),
        (~F.coalesce((F.size("metric_definitions") > 0) & same_keys(F.col("metrics"), F.col("metric_definitions")), F.lit(False)), "/metrics", "each metric needs a definition and each definition a metric"),
        (~F.coalesce((F.size("thresholds") > 0) & F.forall(F.map_values("thresholds"), lambda x: F.coalesce(is_finite(x), F.lit(False))), F.lit(False)), "/config/thresholds", "thresholds must be numbers"),
    ]
    cases = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(at).alias("field"), F.lit(m).alias("message"))) for c, at, m in checks)))
    return f.finding(runs.select("document", F.inline(cases)), "evaluation_config", F.col("message"))


def labeling_findings(records: DataFrame) -> DataFrame:
    """From (document, doc map of JSON texts): labeling records need all fields, the kind ``labeling_run``,
    hashes of 64 hexadecimal digits and a command that holds on any machine."""
    absent = records.select("document", F.explode(missing_from(list(LABELING_FIELDS), F.map_keys("doc"))).alias("name"))
    wrong = records.where(F.get_json_object(F.concat(F.lit("["), F.col("doc")["kind"], F.lit("]")), "$[0]") != "labeling_run")
    hashes = records.select("document", F.explode(F.regexp_extract_all(F.to_json("doc"), F.lit(r'sha256\\*"\s*:\s*\\*"([^"\\]*)'), F.lit(1))).alias("digest"))
    command = records.select("document", F.posexplode(F.from_json(F.col("doc")["command"], "array<string>")).alias("pos", "word"))
    return f.all_findings(
        f.finding(absent, "labeling_record", F.concat(F.lit("missing "), F.col("name")), field=F.concat(F.lit("/"), F.col("name"))),
        f.finding(wrong, "labeling_record", "kind must be labeling_run", field=F.lit("/kind")),
        f.finding(hashes.where(~F.rlike("digest", F.lit(SHA256))), "labeling_record", "not a hash", field=F.lit("/sha256")),
        f.finding(command.where(is_machine_path(F.col("word"))), "non_portable_config", "command holds on one machine only", field=F.concat(F.lit("/command/"), F.col("pos").cast("string"))),
    )

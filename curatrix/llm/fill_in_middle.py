"""Fill-in-the-middle transformation of texts, in Spark SQL functions alone.

``regexp_extract_all`` makes the array of a text's units, white space with the word behind it. ``conv`` of
``substring`` of ``sha2`` of seed and id gives two cuts and two draws, so that a document's form depends on its id
alone: no state, the same in any split of the table and any rerun. ``slice`` and ``array_join`` build prefix, middle
and suffix, which sentinels arrange; parsing the sentinels restores the text.

A text that holds a sentinel is left plain: then each sentinel stands once in an arrangement, also across the
borders of the parts, as no end of a sentinel begins one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh

#: Fixed value: a unit of text. Java's and RE2's classes mean the same by it.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: Of 100 texts so many are transformed, and of 100 of these so many have the suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80


def draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hex digits as an unsigned integer."""
    return F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, result: str = "fim") -> DataFrame:
    """``docs`` with a column ``result`` (with underscores added where that name is taken): a struct of n, form
    (plain, psm or spm), prefix, middle, suffix (null if plain) and output.

    Null texts count as empty, and empty texts are plain; a null id counts as an empty one. Rows of one id are cut by
    the same draws, equal rows alike. Whole texts are cut, however long. Other columns are kept, whatever their
    names; an empty table gives an empty table.
    """
    name = fresh(docs, result)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    held = [fresh(docs, f"_fim_{k}") for k in ("units", "digest", "low", "high", "form", "parts")]
    units, key, low, high, form, parts = held
    n = F.size(units)
    cuts = [draw(F.col(key), k) % (n + 1) for k in (0, 1)]
    marked = F.lit(False)
    for sentinel in SENTINELS:
        marked |= F.contains(text, F.lit(sentinel))
    plain = (n == 0) | marked | (draw(F.col(key), 2) % 100 >= fim_percent)
    kind = F.when(plain, "plain").when(draw(F.col(key), 3) % 100 < spm_percent, "spm").otherwise("psm")
    join = lambda start, length: F.array_join(F.slice(units, start, length), "")
    cut = F.struct(
        join(F.lit(1), F.col(low)).alias("prefix"),
        join(F.col(low) + 1, F.col(high) - F.col(low)).alias("middle"),
        join(F.col(high) + 1, n - F.col(high)).alias("suffix"),
    )
    spread = docs.withColumns({units: F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), key: digest})
    spread = spread.withColumns({low: F.least(*cuts).cast("int"), high: F.greatest(*cuts).cast("int"), form: kind})
    spread = spread.withColumn(parts, F.when(F.col(form) != "plain", cut))
    prefix, middle, suffix = (F.col(f"{parts}.{c}") for c in ("prefix", "middle", "suffix"))
    output = (
        F.when(F.col(form) == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col(form) == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(text)
    )
    made = F.struct(n.cast("long").alias("n"), F.col(form).alias("form"), prefix.alias("prefix"), middle.alias("middle"), suffix.alias("suffix"), output.alias("output"))
    return spread.select(*(F.col(f"`{c}`") for c in docs.columns), made.alias(name))


def restored(output: Column, form: Column) -> Column:
    """The text of an output, from its sentinels; null if either is null."""
    first, second = (F.when(form == "psm", a).otherwise(b) for a, b in ((PREFIX, SUFFIX), (SUFFIX, PREFIX)))
    inner, last = F.position(second, output), F.position(F.lit(MIDDLE), output)
    width = len(PREFIX)
    ahead = F.substr(output, F.lit(width + 1), inner - width - 1)
    behind = F.substr(output, inner + width, last - inner - width)
    middle = F.substr(output, last + width)
    broken = ~F.startswith(output, first) | (inner == 0) | (last < inner)
    text = F.when(form == "psm", F.concat(ahead, middle, behind)).otherwise(F.concat(behind, middle, ahead))
    return F.when(form == "plain", output).when(broken, F.raise_error(F.lit("sentinels are missing or out of place")).cast("string")).otherwise(text)


def fim_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of each row of ``docs``."""
    made = fill_in_middle(docs.select("doc_id", "text")).select("doc_id", "fim.*")
    return made.select(
        "doc_id", "n", "form",
        F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )

"""Several values packed in one field: infer the delimiters of each source, split, explode with position.

Candidates are scored per source on the fields in which they stand between two numbers:
consistency - the share of those fields in which this candidate alone explains the piece count - and
regularity - the share of gaps between two numbers at which it cuts, so that each piece holds one number.
A candidate is used for a source if the mean of both reaches `accept`; sources with fewer than `min_fields` such fields
take the decision of all sources together.

The comma is a delimiter and a decimal sign. It is decimal in "0,064" (a second piece "064" is no regular number) and
where exactly one digit follows it, no digit, point or comma adjoins, and another delimiter separates the field's
numbers; otherwise it separates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from massquarry.workspace import fresh, stage

# Delimiters that occur between packed values, with the name under which they are scored.
CANDIDATES = {
    "semicolon": ";", "comma": ",", "slash": "/", "pipe": r"\|", "tab": r"\t", "newline": r"[\r\n]", "arrow": "->|→",
    "dash": "–", "hyphen": "-", "plus": r"\+", "ampersand": "&", "underscore": "_", "colon": ":",
    "to": r"\bto\b", "and": r"\band\b",
}

NUMBER = r"(?:\d+\.?\d*|\.\d+)(?:[eE]\d+)?"
CUT = "\u001f"
_SPACES = "[   ]"
#: White space alone between two numbers, the first with an optional unit and closing marks.
_BLANK = rf"((?<![\d.])(?<!\d[eE]){NUMBER}\s*(?:%(?:\s*\(nominal\))?|[A-Za-z]{{1,5}})?[\"')\]}}]*) +(?=[\"'(\[{{]*\.?\d)"
_OTHER = "\\d[^\\d,;]*?[;/|+&:_\t\n\r–→>-][^\\d]*\\d|\\d[^\\d]*?\\b(?:to|and)\\b[^\\d]*\\d"


def decimal_commas(text: Column) -> Column:
    """The field with plain spaces and with decimal commas written as points."""
    s = F.regexp_replace(text, _SPACES, " ")
    s = F.regexp_replace(s, r"(?<![\d.,])0,(\d{1,3})(?![\d.])", "0.$1")
    other = s.rlike(_OTHER) | s.rlike(_BLANK)
    return F.when(other, F.regexp_replace(s, r"(?<![\d.,])(\d+),(\d)(?!\d|\.|,|[eE]\d)", "$1.$2")).otherwise(s)


def _between(pattern: str) -> str:
    return rf"(?<=[\d.A-Za-z%)\]}}\"' ])\s*(?:{pattern})\s*"


#: Text between two numbers; the second is only looked at.
_GAP = rf"(?>{NUMBER})([^\d.][^\d]*?)(?=\.?\d)"


def _kind(gap: Column) -> Column:
    """The candidate that separates two numbers, null if none does; the first one found in the order of CANDIDATES."""
    out = None
    for name, p in CANDIDATES.items():
        out = F.when(gap.rlike(p), name) if out is None else out.when(gap.rlike(p), name)
    return out


def infer_delimiters(df: DataFrame, text: str, source: str, accept: float = 0.5, min_fields: int = 30) -> DataFrame:
    """source, pattern: the regular expression of the delimiters of each source, and in the row with a null source of
    all sources together, which fields without a source use as well.

    The gaps between a field's numbers are cut out once, and counted per source and candidate before the shuffle.
    """
    gaps = F.transform(F.regexp_extract_all(F.col("t"), F.lit(_GAP), 1), _kind)
    fields = df.select(F.col(source).alias("source"), decimal_commas(F.col(text)).alias("t")).select("source", gaps.alias("g")).where(F.size("g") > 0)
    cells = fields.select("source", F.size("g").alias("n"), "g", F.explode(F.array_distinct("g")).alias("candidate")).where(F.col("candidate").isNotNull())
    own = F.size(F.filter("g", lambda x: x == F.col("candidate")))
    cells = cells.select("source", "candidate", (own == F.col("n")).cast("double").alias("consistent"), (own / F.col("n")).alias("regular"))
    # as many rows as sources times candidates; read twice below
    counts = stage(cells.groupBy("source", "candidate").agg(F.count(F.lit(1)).alias("fields"), (F.sum("consistent") + F.sum("regular")).alias("points")), "delimiters")
    pattern = F.create_map(*(F.lit(x) for kv in CANDIDATES.items() for x in kv))
    total = counts.groupBy("candidate").agg(F.sum("fields").alias("all_fields"), F.sum("points").alias("all_points"))
    common = total.select(F.lit(None).cast("string").alias("source"), "candidate", (F.col("all_points") / (2 * F.col("all_fields"))).alias("score"))
    # CANDIDATES bounds the rows of `total`
    cells = counts.where(F.col("source").isNotNull()).select("source").distinct().join(F.broadcast(total)).join(counts, ["source", "candidate"], "left")
    score = F.when(F.col("fields") >= min_fields, F.col("points") / (2 * F.col("fields"))).otherwise(F.col("all_points") / (2 * F.col("all_fields")))
    rows = cells.select("source", "candidate", score.alias("score")).unionByName(common).where(F.col("score") >= accept)
    return rows.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set(pattern[F.col("candidate")])), "|").alias("pattern"))


def split_packed(df: DataFrame, text: str, source: str, accept: float = 0.5, min_fields: int = 30) -> DataFrame:
    """df with one row per value of df[text] and the columns step_no (position from 1), n_values, piece and value.

    Fields that are null, empty or hold no number give no row. Repeated rows give repeated results. Empty pieces between
    two delimiters have no position. A piece that still holds several numbers, because a delimiter was not accepted, is
    returned as one piece with a null value, for review. Column names of df that clash with the new ones get the new
    columns under a leading underscore (see massquarry.workspace.fresh).
    """
    step, n, piece, value, src, pat, cut = fresh(df, "step_no", "n_values", "piece", "value", "src__", "pattern__", "cut__")
    rules = stage(infer_delimiters(df, text, source, accept, min_fields).withColumnsRenamed({"source": src, "pattern": pat}), "rules")
    common = rules.where(F.col(src).isNull()).select(F.col(pat).alias(f"{pat}0"))  # one row
    # one row per source: a table read from files, whose size the planner checks before it broadcasts
    out = df.join(rules.where(F.col(src).isNotNull()), F.col(source) == F.col(src), "left").join(F.broadcast(common), how="left")
    p = F.coalesce(F.col(pat), F.col(f"{pat}0"), F.lit("(?!)"))
    t = F.regexp_replace(decimal_commas(F.col(text)), _BLANK, f"$1{CUT}")
    t = F.regexp_replace(t, F.concat(F.lit(r"(?<=[\d.A-Za-z%)\]}\"' " + CUT + r"])\s*(?:"), p, F.lit(r")\s*")), F.lit(CUT))
    pieces = F.filter(F.split(t, CUT), lambda x: x.rlike(r"\d"))
    out = out.withColumn(cut, pieces).withColumn(n, F.size(cut))
    out = out.select("*", F.posexplode(cut).alias(step, piece)).withColumn(step, F.col(step) + 1)
    one = F.size(F.regexp_extract_all(F.col(piece), F.lit(NUMBER), 0)) == 1
    out = out.withColumn(value, F.when(one, F.regexp_extract(piece, NUMBER, 0).cast("double")))
    return out.drop(src, pat, f"{pat}0", cut)

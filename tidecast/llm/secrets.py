"""Secret scans over an incremental ledger of content-addressed texts, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import fresh_path, materialise

from .common import table


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if `group` of it has at least `least` characters. A new pattern needs a new version."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


# Whole runs are matched, so the least length of access and hex can stand in the pattern.
RULES = (
    Rule(
        "assign",
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
LEDGER = "blob binary, rule string, spans array<struct<start:int,end:int>>"


def _spans(text: Column, hits: Column, rule: Rule) -> Column:
    """Code point spans of `hits`, which are the rule's matches in `text`."""
    gaps = F.split(text, rule.pattern, -1)
    values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        counts = F.length(x["value"]) >= rule.least
        return F.struct(end.alias("at"), F.when(counts, F.array_append(seen["spans"], F.struct(start.alias("start"), end.alias("end")))).otherwise(seen["spans"]).alias("spans"))

    return F.aggregate(pairs, begin, step, lambda seen: seen["spans"])


def _addressed(versions: DataFrame, path: str, text: str) -> DataFrame:
    whole = versions.select(versions[path].alias("path"), F.coalesce(versions[text], F.lit("")).alias("text"))
    return whole.withColumn("blob", _address(F.col("text")))


def _address(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def update(versions: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks of these versions, append it, and return the versions' (path, blob)."""
    spark = versions.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(ledger)
    whole = _addressed(versions, path, text)
    paths = materialise(whole.select("path", "blob"), "paths")
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = spark.read.schema(LEDGER).parquet(ledger).groupBy("blob").agg(F.collect_set(F.when(F.array_contains(names, F.col("rule")), F.col("rule"))).alias("seen"))
    first = paths.groupBy("blob").agg(F.min("path").alias("path"))
    todo = first.join(seen, "blob", "left").select("blob", "path", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo")).where(F.size("todo") > 0)
    todo = materialise(todo, "unseen").select(F.col("blob").alias("todo_blob"), F.col("path").alias("todo_path"), "todo")
    # The path spreads the copies of one text; the small side is built, so texts are not sorted.
    unseen = whole.join(todo.hint("shuffle_hash"), whole["path"].eqNullSafe(todo["todo_path"]) & (whole["blob"] == todo["todo_blob"]))
    hits = [F.when(F.array_contains("todo", F.lit(r.name)), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).alias(f"hits_{r.kind}") for r in rules]
    matched = unseen.select("blob", "text", "todo", *hits)
    found = [F.when(F.size(f"hits_{r.kind}") > 0, _spans(F.col("text"), F.col(f"hits_{r.kind}"), r)) for r in rules]
    none = F.array().cast("array<struct<start:int,end:int>>")
    entries = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.coalesce(s, none).alias("spans")) for r, s in zip(rules, found)])
    scanned = matched.select("blob", F.filter(entries, lambda e: F.array_contains(F.col("todo"), e["rule"])).alias("entries"))
    scanned = scanned.groupBy("blob").agg(F.any_value("entries").alias("entries")).select("blob", F.inline("entries"))  # rows that repeat path and text
    scanned.write.mode("append").parquet(ledger)
    return paths


def found_in(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(found_blob, findings) of every blob with findings by these rule versions, in order of start and rule."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    entry = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule").isin([r.name for r in rules]) & (F.size("spans") > 0))
    spans = entry.select("blob", "rule", F.explode("spans").alias("s")).select("blob", "s.start", order["rule"].alias("rank"), "s.end", F.split_part("rule", F.lit("/"), F.lit(1)).alias("kind"))
    by_blob = spans.distinct().groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("found"))
    return materialise(by_blob.select(F.col("blob").alias("found_blob"), F.transform("found", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("findings")), "found")


def scan(versions: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per version of a path: path, blob, and findings (kind, start, end) in order of start and rule.

    A text's address is its SHA-256 (a null text is an empty one). The ledger, a Parquet folder that is
    made on first use, has a row for every scanned pair of blob and rule version, with the spans found
    (code points, end exclusive). Only pairs that it lacks are scanned, each blob once, whatever the
    number of paths with that text; the findings then go to every path. So a repeated row, a null path
    and an old version each get their own row, and a second run over the same texts scans nothing.
    Only the two named columns are read. No rows give no rows.
    """
    paths = update(versions, ledger, path, text, rules)
    by_blob = found_in(versions.sparkSession, ledger, rules)
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return paths.join(by_blob, paths["blob"] == by_blob["found_blob"], "left").select("path", "blob", F.coalesce("findings", empty).alias("findings"))


def redact(docs: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", length: str = "n_chars", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with every secret masked in the text, and the text's length set anew where it changed.

    All rows stay, with their columns; a text without findings, or null, stays as it is.
    """
    update(docs, ledger, path, text, rules)
    item = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("item"), _address(F.coalesce(docs[text], F.lit(""))).alias("blob"))
    found = found_in(docs.sparkSession, ledger, rules)
    met = item.join(found, item["blob"] == found["found_blob"], "left")
    new = F.when(F.col("findings").isNotNull(), redacted(F.col(f"item.{text}"), F.col("findings"))).otherwise(F.col(f"item.{text}"))
    met = met.withColumn("new_text", new)
    own = {text: F.col("new_text"), length: F.when(F.col("findings").isNotNull(), F.length("new_text").cast(dict(docs.dtypes).get(length, "long"))).otherwise(F.col(f"item.`{length}`")) if length in docs.columns else None}
    return met.select(*[(own[c] if c in own else F.col(f"item.`{c}`")).alias(c) for c in docs.columns])


def joined(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(text: Column, findings: Column, mask: str = "[secret]") -> Column:
    """The text with every found stretch replaced; stretches that overlap or touch are one."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(seen: Column, x: Column) -> Column:
        gap = F.substring(text, seen["at"] + 1, F.greatest(x["start"] - seen["at"], F.lit(0)))
        fresh = (x["start"] > seen["at"]) | (seen["done"] == "")
        return F.struct(F.greatest(seen["at"], x["end"]).alias("at"), F.concat(seen["done"], gap, F.when(fresh, F.lit(mask)).otherwise("")).alias("done"))

    return F.aggregate(findings, begin, step, lambda seen: F.concat(seen["done"], F.substring(text, seen["at"] + 1, F.length(text))))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), fresh_path(spark, "ledger"))
    kinds = F.transform("findings", lambda x: x["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, lambda k: k == F.lit(r.kind)), False)).cast("long").alias(f"n_{r.kind}") for r in RULES]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(joined(F.col("findings")), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


_ONE = r"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, hits[i] AS hit, values_[i] AS value,
         (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0))::BIGINT AS start
  FROM (SELECT *, unnest(generate_series(1, len(hits))) AS i FROM (
    SELECT row_no AS doc_id, regexp_extract_all(text, {pattern}, 0) AS hits, regexp_extract_all(text, {pattern}, {group}) AS values_,
           string_split_regex(text, {pattern}) AS gaps
    FROM d WHERE regexp_matches(text, {pattern})))"""
SQL = (
    "WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents), h AS ("
    + " UNION ALL ".join(_ONE.format(kind=r.kind, rank=i, group=r.group, pattern="'" + r.pattern.replace("'", "''") + "'") for i, r in enumerate(RULES))
    + """
), f AS (
  SELECT doc_id AS row_no, kind, concat_ws(':', kind, start, start + length(hit)) AS span, start, rank FROM h
  WHERE length(value) >= CASE WHEN kind = 'assign' THEN 8 ELSE 1 END
), g AS (
  SELECT row_no, string_agg(span, ',' ORDER BY start, rank) AS spans, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex FROM f GROUP BY row_no
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row_no)
"""
)

"""Queries of the annotation engine's operators on the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions import text as T
from tagweave.operators import sequences as S
from tagweave.session import ship


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def line_stats(spark, sf_dir):
    """Lines, blank lines and the longest line of each document."""
    lines = _lines(spark, sf_dir)
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(T.is_blank(F.col("line"))).alias("n_blank"), F.max(F.length("line")).cast("long").alias("longest"))


def normalise_text(spark, sf_dir):
    return _read(spark, sf_dir, "benchmark").select("item_id", T.strip_whitespace(T.normalise(F.col("text"))).alias("normal"))



def repeated_lines(spark, sf_dir):
    """Running headers: lines of two words or more, not all digits and dots, that a document repeats, most frequent first."""
    lines = _lines(spark, sf_dir).withColumn("line", F.trim("line"))
    ok = lines.filter("line <> ''").filter(~F.col("line").rlike(r"^[0-9. ]+$")).filter(F.size(F.split("line", " +")) >= 2)
    return ok.groupBy("doc_id", "line").agg(F.count(F.lit(1)).alias("n"), F.min("line_no").cast("long").alias("first_line")).filter("n >= 2 and first_line < 50")


def majority_role(spark, sf_dir):
    """The role that a conversation holds most, ties to the one that speaks first."""
    return S.majority(_read(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role", "role")


def turn_runs(spark, sf_dir):
    """Runs of turns by one role, with their turns and characters."""
    found = S.runs(_read(spark, sf_dir, "conversations"), "conv_id", "turn", "role")
    return found.groupBy("conv_id", "run", "role").agg(F.count(F.lit(1)).alias("n_turns"), F.min("turn").alias("first_turn"), F.sum(F.length("text")).alias("n_chars"))


def fill_both(spark, sf_dir):
    """The last purchase up to, and the next one from, each event of a user; -1 for none."""
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    bought = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    out = S.fill_backward(S.fill_forward(events, "user_id", "event_id", bought, "last_bought"), "user_id", "event_id", bought, "next_bought")
    return out.select("event_id", F.coalesce("last_bought", F.lit(-1)).alias("last_bought"), F.coalesce("next_bought", F.lit(-1)).alias("next_bought"))




def begin_inside_tags(spark, sf_dir):
    """Turns of a conversation labelled by role, b- where a run of it begins."""
    found = S.runs(_read(spark, sf_dir, "conversations"), "conv_id", "turn", "role")
    return S.begin_inside(found, ["conv_id", "run"], "turn", "role").select("conv_id", "turn", "tag")


def tag_replace(spark, sf_dir):
    """user becomes human, system is cleared; prefixes stay."""
    tags = begin_inside_tags(spark, sf_dir)
    return tags.select("conv_id", "turn", S.replace_tags(F.col("tag"), {"user": "human", "system": None}).alias("tag"))



def url_parts(spark, sf_dir):
    """Directory, name and extension of each page's address."""
    u = F.col("url")
    return _read(spark, sf_dir, "pages").select("page_id", F.regexp_extract(u, "^(.*/)?([^/]*)$", 1).alias("dir"), F.regexp_extract(u, "^(.*/)?([^/]*)$", 2).alias("name"))


def longest_first(spark, sf_dir):
    """Lines of each benchmark item, longest first, ties in their order."""
    items = _read(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    rows = items.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct((-F.length("line")).alias("k"), "at", "line"))).alias("l"))
    return rows.select("item_id", F.array_join(F.col("l.line"), "|").alias("lines"))




QUERIES = {f.__name__: f for f in (line_stats, normalise_text, repeated_lines, majority_role, turn_runs, fill_both, begin_inside_tags, tag_replace, url_parts, longest_first)}

_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)"
_RUNS = """(SELECT *, sum(st) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role AND row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1 THEN 0 ELSE 1 END AS st FROM conversations))"""
_TAGS = f"(SELECT conv_id, turn, CASE WHEN row_number() OVER (PARTITION BY conv_id, run ORDER BY turn) = 1 THEN 'b-' ELSE 'i-' END || role AS tag FROM {_RUNS})"
ORACLES = {
    "line_stats": f"SELECT doc_id, count(*) AS n_lines, count(*) FILTER (trim(line) = '') AS n_blank, max(length(line)) AS longest FROM {_LINES} GROUP BY doc_id",
    "normalise_text": "SELECT item_id, regexp_replace(regexp_replace(replace(regexp_replace(replace(translate(lower(replace(text, '&apos;', '\"')), '–— ''', '-- \"'), chr(9), ' '), ' +', ' ', 'g'), chr(13), chr(10)), ' *\\n *', chr(10), 'g'), '\\n+', chr(10), 'g') AS normal FROM benchmark",
    "repeated_lines": f"SELECT doc_id, line, count(*) AS n, CAST(min(line_no) AS BIGINT) AS first_line FROM (SELECT doc_id, line_no, trim(line, ' ') AS line FROM {_LINES}) WHERE line <> '' AND NOT regexp_matches(line, '^[0-9. ]+$') AND len(regexp_split_to_array(line, ' +')) >= 2 GROUP BY doc_id, line HAVING count(*) >= 2 AND min(line_no) < 50",
    "majority_role": "SELECT conv_id, role, n FROM (SELECT conv_id, role, count(*) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY count(*) DESC, min(turn)) AS k FROM conversations GROUP BY conv_id, role) WHERE k = 1",
    "turn_runs": f"SELECT conv_id, CAST(run AS BIGINT) AS run, role, count(*) AS n_turns, min(turn) AS first_turn, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM {_RUNS} GROUP BY conv_id, run, role",
    "fill_both": "SELECT event_id, coalesce(last_value(b IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), -1) AS last_bought, coalesce(first_value(b IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), -1) AS next_bought FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN event_id END AS b FROM events)",
    "begin_inside_tags": f"SELECT * FROM {_TAGS}",
    "tag_replace": f"SELECT conv_id, turn, CASE WHEN tag LIKE '%-system' THEN NULL WHEN tag LIKE '%-user' THEN left(tag, 2) || 'human' ELSE tag END AS tag FROM {_TAGS}",
    "url_parts": "SELECT page_id, regexp_extract(url, '^(.*/)?([^/]*)$', 1) AS dir, regexp_extract(url, '^(.*/)?([^/]*)$', 2) AS name FROM pages",
    "longest_first": "SELECT item_id, string_agg(line, '|' ORDER BY length(line) DESC, pos) AS lines FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM benchmark) GROUP BY item_id",
}

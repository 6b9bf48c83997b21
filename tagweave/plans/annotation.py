"""Queries of tagging, segmentation, markup, reference and file operators, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions import ident, mapping
from tagweave.operators import matching as M
from tagweave.operators import preserving as P
from tagweave.operators import references as O
from tagweave.operators import segments as G
from tagweave.operators import sequences as S
from tagweave.operators import trees
from tagweave.plans.passages import exact_spans
from tagweave.session import ship
from tagweave.sources import files


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return ship(spark).createDataFrame(rows, schema)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))
    section = F.when(F.col("line_no") == 0, "front").when(F.col("text").contains("@"), "reference").when(F.col("text") == "", "annex")
    return lines.withColumn("section", section)


def passage_tags(spark, sf_dir):
    """Words of documents that hold a benchmark item, tagged b- and i- by item where an item covers them."""
    docs = _read(spark, sf_dir, "documents")
    spans = exact_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    spans = spans.select("doc_id", F.col("item_id").alias("ordinal"), F.concat(F.lit("item"), "item_id").alias("field"), "start", "end")
    words = docs.join(spans.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", F.posexplode(F.split("text", " ", -1)).alias("token_no", "token"))
    tokens = S.offsets(words, "doc_id", "token_no", "token", 1).filter("token <> ''")
    return M.tag_tokens(tokens, spans, "doc_id").filter("tag is not null").select("doc_id", "token_no", "token", "tag")


def match_report(spark, sf_dir):
    """Matches of benchmark items numbered by document, with the length and start of the text that they cover."""
    docs = _read(spark, sf_dir, "documents")
    spans = exact_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", F.lit("item").alias("field"), F.col("item_id").alias("ordinal"), F.lit(0).alias("part"), "start", "end")
    return files.match_report(spans, docs, "doc_id").select("doc_id", F.col("id").cast("long").alias("id"), "ordinal", F.length("matched").cast("long").alias("n"), F.substring("matched", 1, 20).alias("head"))


def fuzzy_passages(spark, sf_dir):
    """Where benchmark items stand in documents, copied or a little changed; pairs to align share six consecutive words."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")

    def grams(df: DataFrame, key: str) -> DataFrame:
        w = df.select(key, F.filter(F.split(F.lower("text"), r"\s+"), lambda x: x != "").alias("w"))
        return w.select(key, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 5, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice("w", i, 6), " "))))).alias("g"))

    pairs = grams(docs, "doc_id").join(grams(items, "item_id"), "g").select("doc_id", "item_id").distinct().join(items, "item_id")
    targets = pairs.select("doc_id", F.concat(F.lit("item"), "item_id").alias("field"), F.col("item_id").cast("int").alias("ordinal"), F.array("text").alias("values"))
    wanted = docs.join(targets.select("doc_id").distinct(), "doc_id", "left_semi")
    return M.fuzzy_spans(wanted, targets, "doc_id").select("doc_id", "field", "start", "end")


def header_lines(spark, sf_dir):
    """How many lines of each document are running headers."""
    lines = G.headers(_lines(spark, sf_dir).withColumn("section", F.lit(None).cast("string")), "doc_id")
    return lines.groupBy("doc_id").agg(F.count_if(F.col("section") == "headnote").alias("n_headnote"))


def merged_sections(spark, sf_dir):
    """Lines by document and section once gaps within a section are filled."""
    return G.merge_sections(_lines(spark, sf_dir), "doc_id").groupBy("doc_id", F.coalesce("section", F.lit("none")).alias("section")).agg(F.count(F.lit(1)).alias("n"))


def segmented_lines(spark, sf_dir):
    """Lines by document and final section; every seventh line held a page number before."""
    lines = _lines(spark, sf_dir).withColumn("has_page", F.col("line_no") % 7 == 6)
    return G.segment(lines, "doc_id", front_limit=10, preserve=True).groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n"))


def late_front(spark, sf_dir):
    """Turns of users (as front) in blocks that begin after the second turn lose their section."""
    turns = _read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line_no"), F.when(F.col("role") == "user", "front").otherwise(F.col("role")).alias("section"))
    return G.clear_late_front(turns, "conv_id", 2).select("conv_id", F.col("line_no").alias("turn"), F.coalesce("section", F.lit("none")).alias("section"))


def _events(spark, sf_dir):
    tag = F.when(F.col("event_type") == "purchase", "b-purchase").when(F.col("event_type") == "click", "i-click")
    return _read(spark, sf_dir, "events").select("event_id", "user_id", tag.alias("tag"))


def tags_expanded_back(spark, sf_dir):
    """Events of a user before a purchase join it."""
    return S.expand_back(_events(spark, sf_dir), "user_id", "event_id", "tag", ["purchase"], "new").select("event_id", F.coalesce("new", F.lit("")).alias("new"))


def tags_expanded_on(spark, sf_dir):
    """Events of a user after a purchase join it."""
    return S.expand_on(_events(spark, sf_dir), "user_id", "event_id", "tag", ["purchase"], "new").select("event_id", F.coalesce("new", F.lit("")).alias("new"))


def tags_preserved(spark, sf_dir):
    """Event types as tags that an event came with: clicks are to be annotated anew, purchases are put back."""
    events = _read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("b-x/"), "event_type").alias("tag"))
    kept = P.prepare(P.set_aside(events, {"buy": "x/purchase", "press": "x/click"}), {"press"}, keep=True)
    return P.put_back(kept, {"buy"}).select("event_id", F.coalesce("tag", F.lit("")).alias("tag"), F.coalesce("preserved_tag", F.lit("")).alias("preserved_tag"))


def role_entities(spark, sf_dir):
    """The text of each run of turns by one role."""
    turns = S.begin_inside(S.runs(_read(spark, sf_dir, "conversations"), "conv_id", "turn", "role"), ["conv_id", "run"], "turn", "role").withColumn("after", F.lit(" "))
    return S.entities(turns, "conv_id", "turn", "tag", "text", "after").select("conv_id", "name", F.col("first").cast("long").alias("first"), "text")


def range_gaps(spark, sf_dir):
    """Turns of a conversation that aren't a user's, as ranges between the user's turns."""
    turns = _read(spark, sf_dir, "conversations")
    last = turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("n"))
    users = turns.filter("role = 'user'").select("conv_id", F.col("turn").alias("s"), (F.col("turn") + 1).alias("e")).join(last, "conv_id")
    return S.gaps(users, "conv_id", "s", "e", "n")


def url_targets(spark, sf_dir):
    """Pages with the page whose name is theirs with digits replaced by 7."""
    pages = _read(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.length("html").cast("string").alias("text"))
    return files.join_targets(pages.select("path").distinct(), pages, "[0-9]$", "7").select("path", "target_path", "target_text").distinct()


def output_names(spark, sf_dir):
    return _read(spark, sf_dir, "pages").select("page_id", files.output_name("{dir}/{name}.tei{ext}", F.col("url")).alias("name"), files.output_path(F.col("url"), "out").alias("path"))


def page_nodes(spark, sf_dir):
    """Elements of each repaired page, how deep they go, and its links with an address."""
    nodes = trees.shred(_read(spark, sf_dir, "pages"), "page_id", "html")
    link = (F.col("tag") == "a") & F.element_at("attrs", F.lit("href")).isNotNull()
    return nodes.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_nodes"), F.max("level").alias("depth"), F.count_if(link).alias("n_links"))


def page_paths(spark, sf_dir):
    """Paragraphs with a class or anywhere in a list, by page."""
    nodes = trees.shred(_read(spark, sf_dir, "pages"), "page_id", "html")
    return trees.select(nodes, "page_id", "//p[@class] | //li//p | /html/body//a[@href]").groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (passage_tags, match_report, fuzzy_passages, header_lines, merged_sections, segmented_lines, late_front, tags_expanded_back, tags_expanded_on, tags_preserved, role_entities, range_gaps, url_targets, output_names, page_nodes, page_paths)}

_SPANS = "(SELECT doc_id, item_id, CAST(strpos(d.text, b.text) - 1 AS BIGINT) AS s, CAST(strpos(d.text, b.text) - 1 + length(b.text) AS BIGINT) AS e, b.text AS item FROM documents d JOIN benchmark b ON length(b.text) > 0 AND contains(d.text, b.text))"
_LINES = "(SELECT doc_id, line_no, text, CASE WHEN line_no = 0 THEN 'front' WHEN contains(text, '@') THEN 'reference' WHEN text = '' THEN 'annex' END AS section FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents))"
_EVENTS = "(SELECT event_id, user_id, CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'click' END AS v, CASE event_type WHEN 'purchase' THEN 'b-purchase' WHEN 'click' THEN 'i-click' END AS tag FROM events)"
_BY = "PARTITION BY user_id ORDER BY event_id"
_TURNS = "(SELECT *, sum(st) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role AND row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1 THEN 0 ELSE 1 END AS st FROM conversations))"
_BASE = "regexp_extract(url, '[^/]*$')"
ORACLES = {
    "passage_tags": f"""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS token, generate_subscripts(string_split(text, ' '), 1) - 1 AS token_no FROM documents WHERE doc_id IN (SELECT doc_id FROM {_SPANS})),
t AS (SELECT *, CAST(sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY token_no) AS BIGINT) - 1 AS e, CAST(sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY token_no) AS BIGINT) - 1 - length(token) AS s FROM w),
h AS (SELECT t.doc_id, token_no, token, p.item_id, p.s AS ps, row_number() OVER (PARTITION BY t.doc_id, token_no ORDER BY p.s, p.item_id) AS k FROM t JOIN {_SPANS} p ON p.doc_id = t.doc_id AND t.e > p.s AND t.s < p.e WHERE token <> '')
SELECT doc_id, CAST(token_no AS INTEGER) AS token_no, token, CASE WHEN row_number() OVER (PARTITION BY doc_id, ps, item_id ORDER BY token_no) = 1 THEN 'b-' ELSE 'i-' END || 'item' || item_id AS tag FROM h WHERE k = 1""",
    "match_report": f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s, item_id) AS id, item_id AS ordinal, length(item) AS n, left(item, 20) AS head FROM {_SPANS}",
    "header_lines": rf"""WITH g AS (SELECT doc_id, text, count(*) AS n, max(count(*)) FILTER (NOT regexp_matches(text, '^(\d|\s|\.)+$') AND len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) >= 2 AND min(line_no) < 50 AND count(*) >= 2) OVER (PARTITION BY doc_id) AS top,
NOT regexp_matches(text, '^(\d|\s|\.)+$') AND len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) >= 2 AND min(line_no) < 50 AND count(*) >= 2 AS ok FROM {_LINES} GROUP BY doc_id, text)
SELECT doc_id, CAST(coalesce(sum(n) FILTER (ok AND n >= greatest(2, top - 1)), 0) AS BIGINT) AS n_headnote FROM g GROUP BY doc_id""",
    "merged_sections": f"""SELECT doc_id, coalesce(CASE WHEN section IS NULL AND b IN ('front', 'annex', 'reference') AND (b = a OR (a IS NULL AND b = 'annex')) THEN b ELSE section END, 'none') AS section, count(*) AS n FROM
(SELECT *, coalesce(last_value(section IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), 'front') AS b, first_value(section IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM {_LINES}) GROUP BY ALL""",
    "late_front": f"SELECT conv_id, turn, CASE WHEN role <> 'user' THEN role WHEN min(turn) OVER (PARTITION BY conv_id, run) > 2 THEN 'none' ELSE 'front' END AS section FROM {_TURNS}",
    "tags_expanded_back": f"""SELECT event_id, coalesce(CASE WHEN v IS NULL AND nxt = 'purchase' THEN CASE WHEN pn AND NOT is_first THEN 'i-' ELSE 'b-' END || nxt WHEN v = 'purchase' AND pn AND NOT is_first THEN 'i-purchase' ELSE tag END, '') AS new FROM
(SELECT *, lag(v) OVER ({_BY}) IS NULL AS pn, row_number() OVER ({_BY}) = 1 AS is_first, first_value(v IGNORE NULLS) OVER ({_BY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt FROM {_EVENTS})""",
    "tags_expanded_on": f"SELECT event_id, coalesce(tag, CASE WHEN last_value(v IGNORE NULLS) OVER ({_BY} ROWS UNBOUNDED PRECEDING) = 'purchase' THEN 'i-purchase' END, '') AS new FROM {_EVENTS}",
    "tags_preserved": "SELECT event_id, CASE event_type WHEN 'purchase' THEN 'b-buy' ELSE '' END AS tag, CASE event_type WHEN 'purchase' THEN 'b-buy' WHEN 'click' THEN '' ELSE coalesce('b-x/' || event_type, '') END AS preserved_tag FROM events",
    "role_entities": f"SELECT conv_id, role AS name, CAST(min(turn) AS BIGINT) AS first, string_agg(text, ' ' ORDER BY turn) AS text FROM {_TURNS} GROUP BY conv_id, run, role",
    "range_gaps": "WITH u AS (SELECT conv_id, turn AS s, turn + 1 AS e FROM conversations WHERE role = 'user'), n AS (SELECT conv_id, max(turn) + 1 AS n FROM conversations GROUP BY conv_id), g AS (SELECT conv_id, coalesce(lag(e) OVER (PARTITION BY conv_id ORDER BY s), 0) AS s, s AS e FROM u UNION ALL SELECT conv_id, max(e), any_value(n) FROM u JOIN n USING (conv_id) GROUP BY conv_id) SELECT conv_id, CAST(s AS BIGINT) AS start, CAST(e AS BIGINT) AS \"end\" FROM g WHERE s < e",
    "url_targets": f"SELECT DISTINCT a.url AS path, b.url AS target_path, CAST(length(b.html) AS VARCHAR) AS target_text FROM pages a JOIN pages b ON regexp_replace({_BASE.replace('url', 'a.url')}, '[0-9]$', '7') = {_BASE.replace('url', 'b.url')}",
    "output_names": rf"SELECT page_id, regexp_replace(url, '/?[^/]*$', '') || '/' || regexp_replace(n, '\.[^.]*$', '') || '.tei' || regexp_extract(n, '\.[^.]*$') AS name, 'out/' || {_BASE} AS path FROM (SELECT *, regexp_replace({_BASE}, '\.gz$', '') AS n FROM pages)",
}

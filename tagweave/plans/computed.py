"""Queries that turn rows of the tables into tagged tokens, markup and reference strings for the operators, and SQL that states their results by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.functions import ident, mapping
from tagweave.functions import text as X
from tagweave.functions.settings import MatchOptions
from tagweave.operators import chains, choices, documents, trees
from tagweave.operators import matching as M
from tagweave.operators import references as O
from tagweave.operators import segments as G
from tagweave.operators import sequences as S
from tagweave.operators import targets as T
from tagweave.session import ship
from tagweave.sources import files


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _filled(template: str) -> F.col:
    """A text with {column} replaced by columns, as strings."""
    parts = []
    for k, piece in enumerate(template.replace("}", "{").split("{")):
        parts.append(F.col(piece).cast("string") if k % 2 else F.lit(piece))
    return F.concat(*parts)


def _by_type(of: dict[str, str], column: str = "event_type"):
    whens = None
    for kind, template in of.items():
        whens = (F if whens is None else whens).when(F.col(column) == kind, _filled(template))
    return whens


def _events(spark, sf_dir):
    tag = F.when(F.col("event_type") == "purchase", "b-purchase").when(F.col("event_type") == "click", "i-click")
    return _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", tag.alias("tag"))


def _escaped(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _turn_markup(spark, sf_dir):
    """Each conversation as markup: an element t with its role for every turn."""
    one = F.concat(F.lit('<t r="'), F.col("role"), F.lit('">'), _escaped(F.col("text")), F.lit("</t>"))
    rows = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", one.alias("x")))).alias("l"))
    return rows.select("conv_id", F.concat(F.lit("<c>"), F.array_join("l.x", ""), F.lit("</c>")).alias("xml"))


def tags_merged(spark, sf_dir):
    """Untagged events of a user after a purchase or click join its group, until the next one."""
    return S.merge_groups(_events(spark, sf_dir), "user_id", "event_id", "tag", {"purchase": "deal"}, "new").select("event_id", F.coalesce("new", F.lit("")).alias("new"))


def tags_merged_inner(spark, sf_dir):
    """The same one level down: events of errors, which lack a tag one level up, are passed over."""
    events = _events(spark, sf_dir).withColumn("parent", F.when(F.col("event_type") != "error", F.lit("b-all")))
    return S.merge_groups(events, "user_id", "event_id", "tag", {"purchase": "deal", "click": "look"}, "new", parent="parent").select("event_id", F.coalesce("new", F.lit("")).alias("new"))


def page_numbers(spark, sf_dir):
    """Turns as lines that hold a number (their length modulo 8); every fourth is a known page."""
    lines = _read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line_no"), (F.length("text") % 8).cast("string").alias("text"), F.when(F.col("turn") % 4 == 3, "page").alias("section"))
    return G.page_numbers(lines, "conv_id").select("conv_id", F.col("line_no").alias("turn"), F.coalesce("section", F.lit("")).alias("section"))


def line_numbers(spark, sf_dir):
    """Events of a user as lines; clicks begin with a number."""
    first = F.when(F.col("event_type") == "click", (F.floor("value") % 40).cast("string")).otherwise(F.col("event_type"))
    tokens = _read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("line_no"), F.lit(0).alias("token_no"), first.alias("token"))
    return G.line_numbers(tokens, ["user_id"], 2, 3, 0.05)


def path_steps(spark, sf_dir):
    """Turns of users by a path with a predicate, and all turns by a deep path."""
    nodes = trees.shred(_turn_markup(spark, sf_dir), "conv_id", "xml")
    some = [trees.select(nodes, "conv_id", p).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("n_chars")).select(F.lit(p).alias("path"), "*") for p in ('/c/t[@r="user"]', "//t")]
    return some[0].unionByName(some[1])


def markup_repaired(spark, sf_dir):
    """Turns in markup whose end tag is another one's."""
    xml = F.concat(F.lit("<t><"), F.col("role"), F.lit(">"), _escaped(F.col("text")), F.lit("</other></t>"))
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", trees.repair(xml).alias("xml"))


def markup_written(spark, sf_dir):
    """Conversations written as markup, each turn a line and an element by its role."""
    tokens = _read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line_no"), F.lit(0).alias("token_no"), F.col("text").alias("token"), F.concat(F.lit("b-"), "role").alias("tag"))
    return trees.to_markup(tokens, "conv_id", {"user": 'note[@type="user"]'})


def reference_tags(spark, sf_dir):
    """Every event as a reference of an author, a dot, words before an identifier (clicks), and et al (views)."""
    c, v = F.col("event_type") == "click", F.col("event_type") == "view"
    parts = [(F.concat(F.lit("A"), F.col("user_id").cast("string")), F.lit("b-author")), (F.lit("."), F.lit(None)), (F.lit("et"), F.when(v, "b-etal")), (F.lit("al"), F.when(v, "i-etal")),
             (F.lit(","), F.lit(None)), (F.lit("doi"), F.lit(None)), (F.lit(":"), F.lit(None)), (F.concat(F.lit("10.1/"), F.col("event_id").cast("string")), F.when(c, "b-idno"))]
    rows = F.array(*[F.struct(F.lit(i).alias("token_no"), t.alias("token"), g.cast("string").alias("tag")) for i, (t, g) in enumerate(parts)])
    tokens = _read(spark, sf_dir, "events").select("event_id", F.explode(rows).alias("r")).select("event_id", "r.*")
    return O.post_process(tokens, ["event_id"]).select("event_id", "token_no", F.coalesce("tag", F.lit("")).alias("tag"))


def line_tags(spark, sf_dir):
    """Gaps of a user's line of events filled: of purchases within the line, of clicks at its edges too."""
    tag = F.when(F.col("event_type") == "purchase", "b-p").when(F.col("event_type").isin("click", "view"), "i-c")
    rows = _read(spark, sf_dir, "events").select("user_id", F.col("event_id").cast("int").alias("token_no"), F.lit("x").alias("token"), tag.alias("tag"))
    return O.extend_to_lines(rows, ["user_id"], ["p"], ["c"]).select("user_id", "token_no", F.coalesce("tag", F.lit("")).alias("tag"))


_REFS = {"click": '<ref>doi: <pub-id pub-id-type="DOI">10.1234/e.{event_id}</pub-id></ref>', "view": "<ref>no. {event_id}</ref>", "purchase": "<ref>x PMID: {event_id}.</ref>", "error": '<ref><pub-id pub-id-type="ISBN">{event_id}</pub-id></ref>', "signup": "<ref>PMC{event_id}, y</ref>"}


def references_fixed(spark, sf_dir):
    """Reference markup made from events, repaired."""
    refs = _read(spark, sf_dir, "events").select("event_id", _by_type(_REFS).alias("xml"))
    return O.fix_references(refs, "xml").select("event_id", "fixed", "changed")


def references_changed(spark, sf_dir):
    """By user, how many references were changed and which, as a metadata record has it."""
    refs = _read(spark, sf_dir, "events").select("user_id", "event_id", _by_type(_REFS).alias("xml"), (F.col("event_type") == "error").alias("repaired"))
    meta = O.metadata_record(O.fix_references(refs, "xml"), "user_id", "event_id", "repaired", F.lit("2024-01-01T00:00:00"))
    return meta.select("user_id", F.array_join(F.transform("meta", lambda m: F.concat_ws("=", m["name"], m["value"])), ";").alias("meta"))


_IDS = {"click": "doi: 10.1234/e.{event_id}. (Epub 2001)", "view": "PMID: {event_id} then PMC{user_id}", "purchase": "wos:{event_id}", "error": "S0123-123X(11)01{user_id}4-X, {event_id}", "signup": "https://dx.doi.org/10.99999/{user_id}.{event_id}/x; [doi]"}


def identifier_kinds(spark, sf_dir):
    """Identifiers of each kind in reference strings made from events."""
    rows = _read(spark, sf_dir, "events").select("event_id", F.lpad(F.col("user_id").cast("string"), 2, "0").alias("user_id"), "event_type").withColumn("event", F.lpad(F.col("event_id").cast("string"), 15, "0"))
    t = F.when(F.col("event_type") == "purchase", _filled("wos:{event}")).otherwise(_by_type(_IDS))
    cols = {"doi": ident.doi, "url": ident.doi_url_prefix, "pmid": ident.pmid, "pmcid": ident.pmcid, "wos": ident.wos}
    return rows.select("event_id", *[f(t).alias(k) for k, f in cols.items()])


def list_specs(spark, sf_dir):
    """Turns of the roles that a list with additions and removals names."""
    roles = mapping.list_algebra("+user,-system", ["assistant", "system"])
    return _read(spark, sf_dir, "conversations").filter(F.col("role").isin(roles)).groupBy("role").agg(F.count(F.lit(1)).alias("n"))


def required_fields(spark, sf_dir):
    """Whether suppliers' names (found) are as the names of customers with their number (expected)."""
    names = lambda t, k, n: _read(spark, sf_dir, t).select(F.col(k).alias("id"), F.lit("name").alias("field"), F.col(n).alias("text"))
    return M.required_fields(names("customer", "c_custkey", "c_name"), names("supplier", "s_suppkey", "s_name"), "id", ["name"], ["name"], 0.5)


def required_check(spark, sf_dir):
    """Names of parts against those of the next part, passed at a ratio of 0.5."""
    parts = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    pairs = parts.join(parts.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("next_name")), "p_partkey")
    ratio = X.levenshtein_ratio(F.col("p_name"), F.col("next_name"))
    return pairs.select("p_partkey", F.round(ratio, 6).alias("ratio"), (ratio >= 0.5).alias("passed"))


def token_offsets(spark, sf_dir):
    """Each token of the benchmark items with its span."""
    items = _read(spark, sf_dir, "benchmark").select("item_id", F.posexplode(X.tokens(F.col("text"))).alias("token_no", "token"))
    return S.offsets(items, "item_id", "token_no", "token").select("item_id", F.col("token_no").cast("long").alias("token_no"), "token", "start", "end")


def resume_anti(spark, sf_dir):
    """Pages without an output, those with an even number having one."""
    pages = _read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("in/"), F.col("page_id").cast("string"), F.lit(".xml")).alias("path"))
    done = pages.filter(F.col("page_id") % 2 == 0).select(files.output_path(F.col("path"), "out").alias("path"))
    return files.unfinished(pages, done, "out").select("page_id", "path")


def pair_semi(spark, sf_dir):
    """Documents and labels paired by number, where both files exist (documents with an odd id don't)."""
    listed = lambda t, d: _read(spark, sf_dir, t).select(F.col("doc_id").alias("index"), F.concat(F.lit(d), F.col("doc_id").cast("string")).alias("path"))
    docs, labels = listed("documents", "d/"), listed("labels", "l/")
    return files.pairs(docs, labels, docs.filter(F.col("index") % 2 == 0).select("path").unionByName(labels.select("path")))


def html_title(spark, sf_dir):
    """Titles and paragraphs of repaired pages, by paths."""
    nodes = trees.shred(_read(spark, sf_dir, "pages"), "page_id", "html")
    return trees.select(nodes, "page_id", "//title").groupBy("page_id").agg(F.count(F.lit(1)).alias("n_titles"), F.min("content").alias("title"))


def untagged_stretches(spark, sf_dir):
    """Events of a user without a tag, by maximal stretch; errors count as blanks."""
    out = S.untagged_runs(_events(spark, sf_dir), ["user_id"], "event_id", "tag", F.col("event_type") == "error")
    return out.groupBy("user_id", "run").agg(F.min("event_id").alias("first"), F.count(F.lit(1)).alias("n"))


def next_turns(spark, sf_dir):
    """Each turn with the role and the length of the next one."""
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n"))
    return S.next_pairs(turns, "conv_id", "turn", ["role", "n"]).select("conv_id", "turn", F.coalesce("next_role", F.lit("")).alias("next_role"), F.coalesce("next_n", F.lit(0)).alias("next_n"))


def documents_merged(spark, sf_dir):
    """Two taggings of the same turns in one: the second's tag counts where it has one."""
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("token"))
    a = turns.withColumn("tag", F.when(F.col("turn") % 2 == 0, "b-even"))
    b = turns.withColumn("tag", F.when(F.col("turn") % 3 == 0, "b-third"))
    return documents.merge_documents(a, b, ["conv_id", "turn"], "token", "tag").select("conv_id", "turn", F.coalesce("tag", F.lit("")).alias("tag"))


def tag_counts(spark, sf_dir):
    """How often each tag and sub tag stands in a user's events."""
    events = _events(spark, sf_dir).withColumn("sub_tag", F.when(F.col("event_type") == "error", "i-bad"))
    return documents.tag_counts(events, "user_id")


def matches_accepted(spark, sf_dir):
    """Line items as matches with scores, and which are good enough, also by the next of their order."""
    rows = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("int").alias("count"), (F.col("l_discount") * 10).alias("ratio"), (F.col("l_tax") * 12).alias("b_gap_ratio"), (F.col("l_discount") * 9).alias("a_ratio")
    )
    match = F.struct("count", "ratio", "b_gap_ratio", "a_ratio")
    nxt = F.lead(match).over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "count", "ratio", "b_gap_ratio"))
    good = choices.accepted(match, 0.6, 20, 0.7, 45, 0.5, nxt)
    return rows.withColumn("good", good).groupBy("l_orderkey").agg(F.count_if("good").alias("n_good"), F.count(F.lit(1)).alias("n"))


def matches_bonded(spark, sf_dir):
    """Clicks of a user as matches at positions, taken in order while near to one taken before."""
    rows = _read(spark, sf_dir, "events").filter("event_type = 'click'").select("user_id", "event_id", F.floor(F.col("value") % 100).alias("position"))
    return choices.bonded(rows, ["user_id"], "event_id", "position", 5).select("user_id", "event_id", "position")


def matches_confirmed(spark, sf_dir):
    """Turns as matches; users' only stand if the next turn is no more than 20 characters longer or shorter."""
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("role") == "user").alias("conditional"), F.length("text").alias("at"))
    return choices.confirmed(rows, "conv_id", "turn", "at", "at", "conditional", 20).select("conv_id", "turn")


def junk_removed(spark, sf_dir):
    """Texts of turns less the characters that the line matcher passes over."""
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", X.without_junk(F.col("text")).alias("text"))


def word_edges(spark, sf_dir):
    """Whether turns begin and end with a word, their first and last word, and where the first one after 40 characters begins."""
    t, words = F.col("text"), F.split("text", " ")
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", X.starts_with_word(t).alias("starts"), X.ends_with_word(t).alias("ends"), F.coalesce(X.item(words, -1), F.lit("")).alias("last"), F.coalesce(X.item(words, 30), F.lit("")).alias("far"))


def layout_texts(spark, sf_dir):
    """Suppliers of each nation as layout markup (a page a nation, a block a supplier, a line each for name and balance), as text."""
    line = lambda *words: F.concat(F.lit("<TextLine>"), *[F.concat(F.lit('<String CONTENT="'), w, F.lit('"/><SP/>')) for w in words], F.lit("</TextLine>"))
    block = F.concat(F.lit("<TextBlock>"), line(F.lit("name"), F.col("s_name")), line(F.col("s_suppkey").cast("string")), F.lit("<TextLine/></TextBlock>"))
    rows = _read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", block.alias("x")))).alias("l"))
    page = lambda x: F.concat(F.lit("<Page>"), x, F.lit("</Page>"))
    xml = F.concat(F.lit('<alto xmlns="http://www.loc.gov/standards/alto/ns-v3#"><Layout>'), page(F.array_join("l.x", "")), page(F.element_at("l.x", 1)), F.lit("</Layout></alto>"))
    return documents.layout_text(rows.select("s_nationkey", xml.alias("xml")), "xml").select("s_nationkey", "text")


_PEOPLE = {"person": {"name": "n", "segment": "s[@k='seg']", "segment.priority": "1", "segment.extract-regex": "([A-Z]+)"}}


def target_values(spark, sf_dir):
    """Names and segments of customers from markup, by a mapping; the segment has priority."""
    xml = F.concat(F.lit("<person><n>"), F.col("c_name"), F.lit("</n><s k='seg'>"), F.col("c_mktsegment"), F.lit("</s><s>no</s></person>"))
    found = T.target_values(_read(spark, sf_dir, "customer").select("c_custkey", xml.alias("xml")), "c_custkey", "xml", _PEOPLE)
    return found.select("c_custkey", "ordinal", "field", F.element_at("values", 1).alias("value"))


def annotated_headers(spark, sf_dir):
    """Training markup of suppliers annotated with the values of their articles, written anew and checked."""
    suppliers = _read(spark, sf_dir, "supplier")
    docs = suppliers.select("s_suppkey", F.concat(F.lit("<tei><text><front>This long report was made by "), F.col("s_name"), F.lit("<lb/>in area "), F.col("s_nationkey").cast("string"), F.lit(" of the world<lb/></front></text></tei>")).alias("xml"))
    articles = suppliers.select("s_suppkey", F.concat(F.lit("<article><who>"), F.col("s_name"), F.lit("</who><what>of the world</what></article>")).alias("xml"))
    sections = {"article": {"who": "who", "what": "what"}}
    return chains.run(docs, articles, "s_suppkey", "xml", sections, MatchOptions(), "front", required=("who",), matching=("who", "what"))


def sub_annotations(spark, sf_dir):
    """Customers' names found in their texts with the word before (a prefix pattern), and the number in the name as a sub value."""
    text = F.concat(F.lit("Bought by client no. "), F.col("c_custkey").cast("string"), F.lit(" "), F.col("c_name"), F.lit(" in the market of "), F.col("c_mktsegment"))
    number = F.substring_index("c_name", "#", -1)
    rows = _read(spark, sf_dir, "customer").select("c_custkey", text.alias("text"), "c_name", number.alias("number"))
    sub = F.array(F.struct(F.lit("number").alias("field"), F.array("number").alias("values")))
    targets = rows.select("c_custkey", F.lit("name").alias("field"), F.lit(0).alias("ordinal"), F.array("c_name").alias("values"), sub.alias("sub"))
    spans = M.fuzzy_spans(rows, targets, "c_custkey")
    whole = M.with_prefixes(spans, rows, targets, "c_custkey", {"name": r"client no\. \d+ $"})
    subs = M.sub_spans(spans, rows, targets, "c_custkey")
    both = whole.unionByName(subs).join(rows.select("c_custkey", "text"), "c_custkey")
    return both.select("c_custkey", "field", F.col("text").substr((F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")).alias("found"))


def section_checks(spark, sf_dir):
    """Whether each part's brand and type are found in the section that holds its texts."""
    parts = _read(spark, sf_dir, "part")
    found = parts.select("p_partkey", F.lit("front").alias("name"), F.lit(0).alias("position"), F.concat_ws(" ", "p_name", "p_brand").alias("text"))
    expected = parts.select("p_partkey", F.lit("brand").alias("field"), F.col("p_brand").alias("text")).unionByName(parts.filter("p_size > 25").select("p_partkey", F.lit("kind").alias("field"), F.lit("0123456789").alias("text")))
    return documents.section_check(found, expected, "p_partkey", {"front": ["brand", "kind"]}, ["kind"], ["brand"])


QUERIES = {
    f.__name__: f
    for f in (
        tags_merged, tags_merged_inner, page_numbers, line_numbers, path_steps, markup_repaired, markup_written, reference_tags, line_tags, references_fixed, references_changed, identifier_kinds, list_specs,
        required_fields, required_check, token_offsets, resume_anti, pair_semi, html_title, untagged_stretches, next_turns, documents_merged, tag_counts, matches_accepted, matches_bonded, matches_confirmed,
        junk_removed, word_edges, layout_texts, target_values, annotated_headers, sub_annotations, section_checks,
    )
}

_EVENTS = "(SELECT event_id, user_id, event_type, value, CASE event_type WHEN 'purchase' THEN 'b-purchase' WHEN 'click' THEN 'i-click' END AS tag FROM events)"
_BY = "PARTITION BY user_id ORDER BY event_id"
_ESCAPED = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_LEVENSHTEIN = "1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b}))"
ORACLES = {
    "tags_merged": f"SELECT event_id, coalesce(tag, CASE WHEN last_value(tag IGNORE NULLS) OVER ({_BY} ROWS UNBOUNDED PRECEDING) = 'b-purchase' THEN 'i-deal' END, '') AS new FROM {_EVENTS}",
    "tags_merged_inner": f"SELECT event_id, CASE WHEN tag IS NOT NULL THEN tag WHEN event_type = 'error' THEN '' ELSE coalesce(CASE last_value(tag IGNORE NULLS) OVER ({_BY} ROWS UNBOUNDED PRECEDING) WHEN 'b-purchase' THEN 'i-deal' WHEN 'i-click' THEN 'i-look' END, '') END AS new FROM {_EVENTS}",
    "page_numbers": """WITH RECURSIVE l AS (SELECT conv_id, turn, length(text) % 8 AS n, turn % 4 = 3 AS page, min(CASE WHEN turn % 4 = 3 THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
m AS (SELECT l.*, p.n AS next_n FROM l LEFT JOIN l p ON p.conv_id = l.conv_id AND p.turn = l.at),
r AS (SELECT conv_id, NULL::BIGINT AS turn, CAST(0 AS BIGINT) AS k, CAST(1 AS BIGINT) AS least, '' AS section FROM m WHERE k = 1
UNION ALL SELECT m.conv_id, m.turn, m.k, CASE WHEN page THEN n WHEN n >= least AND n < next_n THEN least + 1 ELSE least END, CASE WHEN page OR (n >= least AND n < next_n) THEN 'page' ELSE '' END FROM r JOIN m ON m.conv_id = r.conv_id AND m.k = r.k + 1)
SELECT conv_id, turn, section FROM r WHERE k > 0""",
    "line_numbers": """WITH RECURSIVE a AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) % 40 END AS n, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos, count(*) OVER (PARTITION BY user_id) AS n_lines FROM events),
c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n, pos) AS k FROM a WHERE n > 0),
r AS (SELECT user_id, event_id, n, pos, k, n AS last_n, pos AS last_pos, CAST(1 AS BIGINT) AS seq, TRUE AS taken, n_lines FROM c WHERE k = 1
UNION ALL SELECT c.user_id, c.event_id, c.n, c.pos, c.k, CASE WHEN c.pos < last_pos OR c.n = last_n THEN last_n ELSE c.n END, CASE WHEN c.pos < last_pos OR c.n = last_n THEN last_pos ELSE c.pos END,
  CASE WHEN c.pos < last_pos OR c.n = last_n OR c.n <= last_n + 4 THEN seq ELSE seq + 1 END, NOT (c.pos < last_pos OR c.n = last_n), c.n_lines FROM r JOIN c ON c.user_id = r.user_id AND c.k = r.k + 1),
s AS (SELECT *, count(*) OVER (PARTITION BY user_id, seq) AS size FROM r WHERE taken), g AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS total FROM s WHERE size >= 2)
SELECT user_id, event_id AS line_no FROM g WHERE total >= 0.05 * n_lines""",
    "path_steps": """SELECT '//t' AS path, conv_id, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY conv_id UNION ALL SELECT '/c/t[@r="user"]', conv_id, count(*), CAST(sum(length(text)) AS BIGINT) FROM conversations WHERE role = 'user' GROUP BY conv_id""",
    "markup_repaired": f"SELECT conv_id, turn, '<t><' || role || '>' || {_ESCAPED} || '</' || role || '></t>' AS xml FROM conversations",
    "markup_written": f"SELECT conv_id, '<tei><text>' || string_agg(CASE role WHEN 'user' THEN '<note type=\"user\">' ELSE '<' || role || '>' END || {_ESCAPED} || CASE role WHEN 'user' THEN '</note>' ELSE '</' || role || '>' END, '<lb/>' ORDER BY turn) || '</text></tei>' AS xml FROM conversations GROUP BY conv_id",
    "reference_tags": """SELECT event_id, CAST(k AS INTEGER) AS token_no, CASE WHEN k = 0 THEN 'b-author' WHEN k = 1 THEN 'i-author' WHEN k IN (2, 3) AND event_type = 'view' THEN 'i-author'
WHEN event_type = 'click' AND k = 5 THEN 'b-idno' WHEN event_type = 'click' AND k > 5 THEN 'i-idno' ELSE '' END AS tag FROM events, range(8) t(k)""",
    "line_tags": """WITH a AS (SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 'p' WHEN 'click' THEN 'c' WHEN 'view' THEN 'c' END AS v FROM events),
b AS (SELECT *, CASE WHEN v IS NOT DISTINCT FROM lag(v) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS st FROM a WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
c AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM b),
g AS (SELECT user_id, run, any_value(v) AS v, count(*) AS n, max(run) OVER (PARTITION BY user_id) AS last FROM c GROUP BY user_id, run),
h AS (SELECT *, lag(v) OVER w AS pv, lag(n) OVER w AS pn, lead(v) OVER w AS nv, lead(n) OVER w AS nn, lag(v, 2) OVER w AS ppv FROM g WINDOW w AS (PARTITION BY user_id ORDER BY run))
SELECT c.user_id, CAST(c.event_id AS INTEGER) AS token_no, CASE WHEN c.v = 'c' THEN 'i-c'
WHEN c.v = 'p' THEN CASE WHEN c.st = 1 AND NOT (h.pv IS NULL AND c.run > 1 AND coalesce(h.ppv, '') = 'p') THEN 'b-p' ELSE 'i-p' END
WHEN c.run > 1 AND c.run < h.last THEN CASE WHEN h.pv = 'p' AND h.nv = 'p' THEN 'i-p' ELSE '' END
WHEN c.run > 1 THEN CASE WHEN h.pv = 'c' AND h.pn > h.n THEN 'i-c' ELSE '' END
WHEN h.nv = 'c' AND h.nn > h.n THEN CASE WHEN c.st = 1 THEN 'b-c' ELSE 'i-c' END ELSE '' END AS tag FROM c JOIN h ON h.user_id = c.user_id AND h.run = c.run""",
    "references_fixed": """SELECT event_id, CASE event_type WHEN 'click' THEN '<ref>doi: <pub-id pub-id-type="doi">10.1234/e.' || event_id || '</pub-id></ref>' WHEN 'view' THEN '<ref>no. ' || event_id || '</ref>'
WHEN 'purchase' THEN '<ref>x PMID: <pub-id pub-id-type="pmid">' || event_id || '</pub-id>.</ref>' WHEN 'error' THEN '<ref><pub-id pub-id-type="isbn">' || event_id || '</pub-id></ref>'
ELSE '<ref><pub-id pub-id-type="pmcid">PMC' || event_id || '</pub-id>, y</ref>' END AS fixed, event_type <> 'view' AS changed FROM events""",
    "references_changed": """SELECT user_id, 'fix-jats-note=This XML file had been modified to fix some of the potential errors.;fix-jats-run-timestamp=2024-01-01T00:00:00;fix-jats-malformatted-xml=' || CASE WHEN bool_or(event_type = 'error') THEN 'true' ELSE 'false' END
|| ';fix-jats-changed-reference-count=' || count(*) FILTER (event_type <> 'view') || ';fix-jats-changed-reference-ids=' || coalesce(string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY CAST(event_id AS VARCHAR)) FILTER (event_type <> 'view'), '') AS meta FROM events GROUP BY user_id""",
    "identifier_kinds": """SELECT event_id, CASE event_type WHEN 'click' THEN '10.1234/e.' || event_id WHEN 'signup' THEN '10.99999/' || lpad(CAST(user_id AS VARCHAR), 2, '0') || '.' || event_id || '/x' ELSE '' END AS doi,
CASE event_type WHEN 'signup' THEN 'https://dx.doi.org/' ELSE '' END AS url, CASE event_type WHEN 'view' THEN CAST(event_id AS VARCHAR) ELSE '' END AS pmid, CASE event_type WHEN 'view' THEN 'PMC' || lpad(CAST(user_id AS VARCHAR), 2, '0') ELSE '' END AS pmcid,
CASE event_type WHEN 'purchase' THEN lpad(CAST(event_id AS VARCHAR), 15, '0') ELSE '' END AS wos FROM events""",
    "list_specs": "SELECT role, count(*) AS n FROM conversations WHERE role IN ('assistant', 'user') GROUP BY role",
    "required_fields": f"SELECT c_custkey AS id, s_name IS NOT NULL AND {_LEVENSHTEIN.format(a='c_name', b='s_name')} >= 0.5 AS passed FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey",
    "required_check": f"SELECT a.p_partkey, round({_LEVENSHTEIN.format(a='a.p_name', b='b.p_name')}, 6) AS ratio, {_LEVENSHTEIN.format(a='a.p_name', b='b.p_name')} >= 0.5 AS passed FROM part a JOIN part b ON b.p_partkey - 1 = a.p_partkey",
    "token_offsets": r"""SELECT item_id, CAST(token_no AS BIGINT) AS token_no, token, CAST("end" - length(token) AS BIGINT) AS start, "end" FROM (SELECT *, CAST(sum(length(token)) OVER (PARTITION BY item_id ORDER BY token_no) AS BIGINT) AS "end" FROM
(SELECT item_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS token_no FROM (SELECT item_id, list_filter(regexp_extract_all(regexp_replace(text, '(\p{Ll})(\p{Lu})', '\1' || chr(1) || '\2', 'g'), '[\p{L}\p{N}\p{M}_]+|[^\p{L}\p{N}\p{M}_]'), lambda x: x <> chr(1)) AS t FROM benchmark)))""",
    "resume_anti": "SELECT page_id, 'in/' || page_id || '.xml' AS path FROM pages WHERE page_id % 2 = 1",
    "pair_semi": "SELECT d.doc_id AS index, 'd/' || d.doc_id AS a, 'l/' || d.doc_id AS b FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE d.doc_id % 2 = 0",
    "html_title": """SELECT page_id, CAST(1 AS BIGINT) AS n_titles, replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS title FROM pages WHERE contains(html, '<title>')""",
    "untagged_stretches": f"SELECT user_id, run, min(event_id) AS first, count(*) AS n FROM (SELECT *, CAST(sum(CASE WHEN tag IS NULL AND NOT coalesce(before, FALSE) THEN 1 ELSE 0 END) OVER ({_BY}) AS BIGINT) AS run FROM (SELECT *, lag(tag IS NULL) OVER ({_BY}) AS before FROM {_EVENTS} WHERE event_type <> 'error')) WHERE tag IS NULL GROUP BY user_id, run",
    "next_turns": "SELECT conv_id, turn, coalesce(lead(role) OVER w, '') AS next_role, CAST(coalesce(lead(length(text)) OVER w, 0) AS INTEGER) AS next_n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
    "documents_merged": "SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'b-third' WHEN turn % 2 = 0 THEN 'b-even' ELSE '' END AS tag FROM conversations",
    "tag_counts": "SELECT user_id, CASE event_type WHEN 'error' THEN 'sub_tag' ELSE 'tag' END AS level, CASE event_type WHEN 'error' THEN 'bad' ELSE event_type END AS value, count(*) AS n FROM events WHERE event_type IN ('purchase', 'click', 'error') GROUP BY ALL",
    "matches_accepted": """WITH r AS (SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_quantity AS INTEGER) AS c, l_discount * 10 AS ratio, l_tax * 12 AS b, l_discount * 9 AS a FROM lineitem),
n AS (SELECT *, lead(ratio) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, c, ratio, b) AS nr FROM r)
SELECT l_orderkey, count(*) FILTER ((c >= 45 AND ratio >= 0.5) OR (b >= 0.6 AND ((c >= 20 AND (nr IS NULL OR nr >= 0.5)) OR a >= 0.7))) AS n_good, count(*) AS n FROM n GROUP BY l_orderkey""",
    "matches_bonded": """WITH RECURSIVE c AS (SELECT user_id, event_id, CAST(floor(value % 100) AS BIGINT) AS position, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events WHERE event_type = 'click'),
r AS (SELECT user_id, event_id, position, k, [position] AS taken, TRUE AS ok FROM c WHERE k = 1
UNION ALL SELECT c.user_id, c.event_id, c.position, c.k, CASE WHEN len(list_filter(taken, lambda p: abs(p - c.position) <= 6)) > 0 THEN list_append(taken, c.position) ELSE taken END, len(list_filter(taken, lambda p: abs(p - c.position) <= 6)) > 0 FROM r JOIN c ON c.user_id = r.user_id AND c.k = r.k + 1)
SELECT user_id, event_id, position FROM r WHERE ok""",
    "matches_confirmed": "SELECT conv_id, turn FROM (SELECT *, lead(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE role <> 'user' OR abs(n - length(text)) <= 20",
    "junk_removed": r"""WITH c AS (SELECT conv_id, turn, text, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS k FROM conversations),
p AS (SELECT *, lag(ch) OVER (PARTITION BY conv_id, turn ORDER BY k) AS b FROM c)
SELECT conv_id, turn, coalesce(string_agg(ch, '' ORDER BY k) FILTER (NOT (coalesce(b = '.' AND ch IN (' ', ','), FALSE) OR coalesce(regexp_matches(b, '\p{L}') AND ch = '.', FALSE) OR coalesce(b = ch, FALSE) OR ch = '*')), '') AS text FROM p GROUP BY conv_id, turn""",
    "word_edges": r"SELECT conv_id, turn, regexp_matches(text, '^[\p{L}\p{N}\p{M}_]') AS starts, regexp_matches(text, '[\p{L}\p{N}\p{M}_]$') AND NOT contains(text, chr(10)) AS ends, coalesce(string_split(text, ' ')[-1], '') AS last, coalesce(string_split(text, ' ')[31], '') AS far FROM conversations",
    "layout_texts": r"""SELECT s_nationkey, string_agg(b, chr(10) ORDER BY s_suppkey) || chr(10) || chr(10) || min_by(b, s_suppkey) || chr(10) AS text FROM (SELECT *, 'name ' || s_name || chr(10) || s_suppkey || chr(10) AS b FROM supplier) GROUP BY s_nationkey""",
    "target_values": "SELECT c_custkey, CAST(k AS INTEGER) AS ordinal, CASE k WHEN 0 THEN 'segment' ELSE 'name' END AS field, CASE k WHEN 0 THEN c_mktsegment ELSE c_name END AS value FROM customer, range(2) t(k)",
    "annotated_headers": """SELECT s_suppkey, '<tei><text>This long report was made by <note type="who">' || s_name || '</note><lb/>in area ' || s_nationkey || ' <note type="what">of the world</note></text></tei>' AS xml, TRUE AS passed FROM supplier""",
    "sub_annotations": "SELECT c_custkey, CASE k WHEN 0 THEN 'name' ELSE 'number' END AS field, CASE k WHEN 0 THEN 'client no. ' || c_custkey || ' ' || c_name ELSE string_split(c_name, '#')[-1] END AS found FROM customer, range(2) t(k)",
    "section_checks": "SELECT p_partkey, p_size <= 25 AS passed FROM part",
}

"""Ready-made chains: from training markup and article markup to tagged tokens, new markup and checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.functions import mapping
from tagweave.functions.settings import REFERENCES, MatchOptions, ReferenceOptions, match_options
from tagweave.operators import matching as M
from tagweave.operators import references as O
from tagweave.operators import segments as G
from tagweave.operators import sequences as S
from tagweave.operators import targets as T
from tagweave.operators import trees
from tagweave.operators.documents import compose

Step = Callable[[DataFrame], DataFrame]


def document_tokens(docs: DataFrame, key: str, xml: str, container: str | None = None) -> DataFrame:
    """Tokens of training markup (key, line_no, token_no, token) without tags, and `at`, their number in the document."""
    tokens = trees.token_lines(docs, key, xml, container).withColumn("tag", F.lit(None).cast("string"))
    return tokens.withColumn("at", F.row_number().over(W.partitionBy(key).orderBy("line_no", "token_no")))


def number_lines(tokens: DataFrame, key: str, options: MatchOptions) -> DataFrame:
    """The first token of each numbered line gets the line number's tag, where options ask for it."""
    o = options.line_numbers
    if o is None:
        return tokens
    found = G.line_numbers(tokens, key, o.least, o.gap, o.ratio).withColumn("__n", F.lit(True))
    first = F.min(F.when(F.trim("token") != "", F.col("token_no"))).over(W.partitionBy(key, "line_no")) == F.col("token_no")
    return tokens.join(found, [key, "line_no"], "left").withColumn("tag", F.when(F.col("__n") & first, F.lit(f"b-{o.tag}")).otherwise(F.col("tag"))).drop("__n")


def match(tokens: DataFrame, targets: DataFrame, key: str, options: MatchOptions) -> DataFrame:
    """Targets found in the text of untagged tokens, which get their tags; lines end in a line feed, and a line's gaps are filled where its field's options allow."""
    free = tokens.filter("tag is null")
    ends_line = F.coalesce(F.lead("line_no").over(W.partitionBy(key).orderBy("at")) > F.col("line_no"), F.lit(False))
    placed = S.offsets(free.withColumn("__text", F.concat("token", F.when(ends_line, "\n").otherwise(""))), key, "at", "__text")
    text = placed.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "__text"))), lambda x: x["__text"]), "").alias("text"))
    spelt = {k: v for o in options.tags.values() for k, v in o.spellings.items()}
    spans = M.fuzzy_spans(text, targets.select(key, "field", "ordinal", "values"), key, threshold=options.threshold, spellings=spelt, lines=options.lookahead_lines)
    prefixes = {f: o.match_prefix for f, o in options.tags.items() if o.match_prefix}
    if prefixes:
        spans = M.with_prefixes(spans, text, targets, key, prefixes)
    solid = placed.filter(F.trim("token") != "").select(key, F.col("at").alias("token_no"), "start", "end")
    new = lambda found, to: M.tag_tokens(solid, found, key).select(key, F.col("token_no").alias("at"), F.col("tag").alias(to))
    tagged = tokens.join(new(spans, "__tag"), [key, "at"], "left").withColumn("tag", F.coalesce("tag", "__tag")).drop("__tag")
    if options.sub_annotations:
        tagged = tagged.drop("sub_tag").join(new(M.sub_spans(spans, text, targets, key, options.threshold), "sub_tag"), [key, "at"], "left")
    if not options.extend_to_line:
        return tagged
    merge, extend = [n for n, o in options.tags.items() if o.merge], [n for n, o in options.tags.items() if o.extend_to_line]
    filled = O.extend_to_lines(tagged.filter(F.trim("token") != ""), [key, "line_no"], merge, extend)
    return tagged.drop("tag").join(filled.select(key, "line_no", "token_no", "tag"), [key, "line_no", "token_no"], "left")


def sub_tags(targets: DataFrame, key: str, options: MatchOptions) -> Step:
    """Sub tags only: tokens' tags are hidden from the matcher and put back; no tag is written."""

    def run(t: DataFrame) -> DataFrame:
        hidden = t.withColumn("__old", F.col("tag")).withColumn("tag", F.lit(None).cast("string"))
        only = replace(options, sub_annotations=True, extend_to_line=False)
        return match(hidden, targets, key, only).withColumn("tag", F.col("__old")).drop("__old")

    return run


def annotator(targets: DataFrame, key: str, options: MatchOptions) -> Step:
    """The usual steps: line numbers, if asked for, then the matcher."""
    return compose(lambda t: number_lines(t, key, options), lambda t: match(t, targets, key, options))


def fulltext(targets: DataFrame, key: str, options: MatchOptions, renamed: dict[str, str | None], groups: dict[str, str], expand: tuple[str, ...] = (), back: bool = True, on: bool = True) -> Step:
    """The usual steps, then tags renamed, groups of tags joined, and tags expanded over untagged tokens before and after."""
    steps: list[Step] = [annotator(targets, key, options), lambda t: t.withColumn("tag", S.replace_tags(F.col("tag"), renamed)) if renamed else t]
    steps.append(lambda t: S.merge_groups(t, key, "at", "tag", groups, "tag") if groups else t)
    if expand and back:
        steps.append(lambda t: S.expand_back(t, key, "at", "tag", list(expand), "tag"))
    if expand and on:
        steps.append(lambda t: S.expand_on(t, key, "at", "tag", list(expand), "tag"))
    return compose(*steps)


def reference(targets: DataFrame, key: str, options: MatchOptions, tags: ReferenceOptions = REFERENCES) -> Step:
    """The usual steps, then the repair of references' tags, a line being a reference."""

    def repair(t: DataFrame) -> DataFrame:
        renamed = t.withColumn("tag", S.replace_tags(F.col("tag"), dict(tags.renamed)))
        new = O.post_process(renamed, [key, "line_no"], tags.names, tags.prefixes, tags.marker)
        return t.drop("tag").join(new.select(key, "line_no", "token_no", "tag"), [key, "line_no", "token_no"])

    return compose(annotator(targets, key, options), repair)


def run(docs: DataFrame, articles: DataFrame, key: str, xml: str, sections: dict[str, mapping.Mapping], options: MatchOptions | None = None, container: str | None = None, steps: Callable[[DataFrame, str, MatchOptions], Step] = annotator, required: tuple[str, ...] = (), matching: tuple[str, ...] = ()) -> DataFrame:
    """key, xml and passed: training documents (key, xml) annotated with the values of their articles (key, xml), written anew and checked."""
    options = match_options(options or MatchOptions(), sections)
    targets = T.target_values(articles, key, xml, sections)
    tokens = steps(targets, key, options)(document_tokens(docs, key, xml, container))
    paths = {f: f'note[@type="{f}"]' for f in options.tags}
    written = trees.to_markup(tokens.withColumn("tag", F.coalesce("tag", F.lit(""))), key, paths)
    solid = S.trailing_space(tokens, key, "at", "token", "after").filter(F.trim("token") != "")
    found = S.entities(solid, key, "at", "tag", "token", "after").groupBy(key, F.col("name").alias("field")).agg(F.min_by("text", "first").alias("text"))
    wanted = targets.groupBy(key, "field").agg(F.min_by(F.element_at("values", 1), "ordinal").alias("text"))
    if not (required or matching):
        return written.withColumn("passed", F.lit(True))
    checked = M.required_fields(wanted, found, key, list(required), list(matching), options.threshold)
    return written.join(checked, key, "left").select(key, "xml", F.coalesce("passed", F.lit(False)).alias("passed"))

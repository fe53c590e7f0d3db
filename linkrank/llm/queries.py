"""One registered query per operator, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm.common import Scratch, cut, table

TOKENIZER = "word_bpe_49k.json"

# Fixed values of the URL query.
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents"), min_words=5, near_words=10)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.suffix_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"), written=True)


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.vector_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"), weights=(3.0, 1.0, 2.0), share=1.5, cap=2.0, tilt=1.0)


def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op7_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.paragraph_dedup import paragraph_dedup

    return paragraph_dedup(table(spark, sf_dir, "documents"), threshold=0.8, min_words=20)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.url_filter import url_verdicts

    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.vector_search import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.ngram_join import ngram_classes

    return ngram_classes(table(spark, sf_dir, "documents"), threshold=0.8, n=5)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.align import align

    scratch = Scratch(spark)
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    found = align(table(spark, sf_dir, "documents"), *paths, scratch=scratch)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    result = cut(found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest))
    scratch.release()
    return result


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.language import identify

    return identify(table(spark, sf_dir, "documents"), max_docs=500, max_windows=4)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkrank.llm.spelling import spelling_groups

    found = spelling_groups(table(spark, sf_dir, "documents"), drop_every=97, min_length=5, min_count=3)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_bpe_encode_decode": op5_bpe_encode_decode,
    "op6_toxicity": op6_toxicity,
    "op7_paragraph_dedup": op7_paragraph_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_language_id": op12_language_id,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": pipeline,
}

_HOST = "translate(regexp_extract({u}, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({u}, '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"
_QUERY = "regexp_extract({u}, '^(?s:.*?)://[^/?#]*[^?#]*([^#]*)', 1)"
_NODE = f"nullif({_HOST}, '') || {_PATH} || regexp_extract({{u}}, '^(?s:.*?)://[^/?#]*[^?#]*([^#]*)', 1)"


def _url_sql() -> str:
    """The rules as a CASE, longest first; aliases by a recursive union over declared links."""
    cases = []
    for kind, text in sorted(URL_RULES, key=lambda r: (-len(r[1]), r[0] != "allow")):
        host, _, path = text.partition("/")
        cases.append((f"(host = '{host}' or host like '%.{host}') and path like '/{path}%'", text, kind))
    rule = "case " + " ".join(f"when {c} then '{t}'" for c, t, _ in cases) + " end"
    kind = "case " + " ".join(f"when {c} then '{k}'" for c, _, k in cases) + " end"
    return f"""with recursive
tags as (select url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) as tag from pages
         where url is not null and regexp_matches(html, '(?i)canonical|http-equiv')),
hrefs as (select url, case
    when regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?canonical\\b') then regexp_extract(tag, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    when regexp_matches(tag, '(?i)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b') then regexp_extract(tag, '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    end as t from tags),
refs as (select url, t, regexp_extract(t, '^[^?#]*') as p, {_HOST.format(u="url")} as h, {_PATH.format(u="url")} as up,
    {_QUERY.format(u="url")} as uq from hrefs where t <> ''),
wholes as (select *, substr(t, length(p) + 1) as rest, string_split(substr(case when p like '/%' then p
    else '/' || regexp_extract(up, '(?s)^/(.*/)?', 1) || p end, 2), '/') as s from refs),
dotted as (select *, list_reduce(list_prepend([]::varchar[], list_transform(
    case when s[-1] in ('.', '..') then list_append(s, '') else s end, lambda x: [x])),
    lambda u, x: case when x[1] = '..' then u[1:len(u) - 1] when x[1] = '.' then u else list_concat(u, x) end) as kept from wholes),
links as (select url, case when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') then t
    when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') then null when t like '//%' then 'x:' || t
    when p <> '' then 'x://' || h || '/' || coalesce(array_to_string(kept, '/'), '') || rest
    when t like '?%' then 'x://' || h || up || rest
    else 'x://' || h || up || uq || rest end as target from dotted),
edges as (select {_NODE.format(u="url")} as a, {_NODE.format(u="target")} as b from links where target is not null),
known as (select {_NODE.format(u="u")} as node, {_HOST.format(u="u")} as host, {_PATH.format(u="u")} as path
  from (select url as u from pages union all select target from links where target is not null)),
blocked(node) as (
  select node from known where node is not null and {kind} = 'block'
  union select case when e.a = r.node then e.b else e.a end from blocked r join edges e on r.node in (e.a, e.b)
  where e.a is not null and e.b is not null),
judged as (select page_id, coalesce({_HOST.format(u="url")}, '') as host, coalesce({_PATH.format(u="url")}, '') as path,
  {_NODE.format(u="url")} as node from pages)
select page_id, host, path, {rule} as rule,
  coalesce({kind}, case when node in (select node from blocked where node is not null) then 'block' end, 'allow') as verdict
from judged"""


# Operators that SQL can express over whole tables.
ORACLE_SQL: dict[str, str] = {"op8_url_filter": _url_sql()}

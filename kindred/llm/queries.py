"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import alignment, ann, decontaminate, langid, licenses, lines, minhash, mixing, negatives, pii, simhash, tokencount
from kindred.llm.common import on_workers, sha_list, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def query(spark, sf_dir):
            on_workers(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op8_simhash_near_dedup")
def q_simhash(spark, sf_dir):
    """Fingerprint and component of every document (3-word shingles, 3 bits)."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH doc AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS k
        FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM item WHERE len(w) > 0)),
gram AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
               FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
met AS (SELECT g.doc_id, g.s, g.n, win.id FROM gram g JOIN win ON g.n = win.n AND g.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM met) GROUP BY doc_id),
ids AS (SELECT doc_id, list_sort(list(DISTINCT id)) AS l FROM met GROUP BY doc_id),
place AS (SELECT DISTINCT d.doc_id, i.id, i.n, i.ipos, d.pos + delta - i.ipos AS a0
          FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM doc) d
          JOIN (SELECT id, least(len(w), 10) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS ipos FROM item) i USING (word),
               (SELECT unnest(range(-2, 3)) AS delta)),
run AS (SELECT *, ipos - row_number() OVER (PARTITION BY doc_id, id, a0 ORDER BY ipos) AS g FROM place),
near AS (SELECT doc_id, count(DISTINCT id) AS n_near_items
         FROM (SELECT doc_id, id FROM run GROUP BY doc_id, id, a0, g, n HAVING count(*) >= n) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(l), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM doc LEFT JOIN hit ON doc.doc_id = hit.doc_id LEFT JOIN ids ON doc.doc_id = ids.doc_id
LEFT JOIN near ON doc.doc_id = near.doc_id
"""


@register("op2_benchmark_decontamination", OP2_SQL)
def q_decontaminate(spark, sf_dir):
    """Words of every document that lie in a 10-word window of a benchmark item,
    and the items with a window whose words stand at most 2 words from there."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, slop=2)
    return found.select("doc_id", "n_words", "n_hit", "n_items", sha_list("item_ids").alias("items_sha256"),
                        "contaminated", "n_near_items")


def _cut_sql(units: str) -> str:
    """Oracle of the line operators. ``units`` are CTEs over ``line(doc_id, n,
    raw)`` that end in ``unit(doc_id, n, size, u)``: what is compared."""
    return f"""
WITH line AS (SELECT doc_id, i - 1 AS n, parts[i] AS raw
              FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
                    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text <> ''))),
{units},
ranked AS (SELECT doc_id, n, size, first(doc_id) OVER w AS fd, first(n) OVER w AS fn FROM unit
           WINDOW w AS (PARTITION BY u ORDER BY doc_id, n)),
gone AS (SELECT DISTINCT doc_id, unnest(range(n, n + size)) AS n FROM ranked
         WHERE doc_id <> fd OR n >= fn + size),
cut AS (SELECT line.doc_id, count(*) AS n_lines, count(gone.n) AS n_removed,
               coalesce(string_agg(raw, chr(10) ORDER BY line.n) FILTER (WHERE gone.n IS NULL), '') AS text
        FROM line LEFT JOIN gone ON line.doc_id = gone.doc_id AND line.n = gone.n GROUP BY line.doc_id)
SELECT d.doc_id, CASE WHEN cut.doc_id IS NULL THEN d.text ELSE cut.text END AS text,
       CAST(coalesce(cut.n_lines, CASE WHEN d.text IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN cut ON d.doc_id = cut.doc_id
"""


# From each line with a word on, the fewest lines with 15 words together; the
# first start that has fewer left reaches back to the last line with enough.
_JOINED_SQL = r"""
w AS (SELECT doc_id, n, coalesce(regexp_extract_all(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x20\x09-\x0D]+'), []) AS w FROM line),
d AS (SELECT doc_id, list(array_to_string(w, ' ') ORDER BY n) AS x, list(len(w) ORDER BY n) AS k FROM w GROUP BY doc_id),
c AS (SELECT *, [CAST(coalesce(list_sum(k[1:i]), 0) AS BIGINT) FOR i IN range(0, len(k))] AS before,
             CAST(list_sum(k) AS BIGINT) AS total FROM d),
s AS (SELECT *, unnest(range(1, len(k) + 1)) AS i FROM c),
e AS (SELECT doc_id, x, total - before[i] >= 15 AS whole, i, before, total,
             len([b FOR b IN before IF b < before[i] + 15]) AS last FROM s WHERE k[i] > 0),
f AS (SELECT doc_id, x, i, last FROM e WHERE whole
      UNION ALL SELECT doc_id, any_value(x), greatest(1, len([b FOR b IN any_value(before) IF b <= any_value(total) - 15])), len(any_value(x))
      FROM e WHERE NOT whole GROUP BY doc_id),
unit AS (SELECT DISTINCT doc_id, i - 1 AS n, last - i + 1 AS size, array_to_string([y FOR y IN x[i:last] IF y <> ''], chr(10)) AS u FROM f)"""

_WINDOW_SQL = """
unit AS (SELECT * FROM (SELECT doc_id, n, 3 AS size, list(trim(raw, ' ' || chr(9) || chr(13))) OVER w AS u, count(*) OVER w AS k FROM line
                        WINDOW w AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING))
         WHERE k = 3 AND u <> ['', '', ''])"""


@register("op4_line_hash_dedup", _cut_sql(_JOINED_SQL))
def q_unit_dedup(spark, sf_dir):
    """Every document without the lines (joined to 15 words or more) that an earlier one holds."""
    out = lines.unit_dedup(table(spark, sf_dir, "documents"), least_words=15)
    return out.select("doc_id", F.col("kept").alias("text"), "n_lines", "n_removed")


@register("op5_line_window_dedup", _cut_sql(_WINDOW_SQL))
def q_window_dedup(spark, sf_dir):
    """Every document without later occurrences of repeated three-line windows."""
    out = lines.window_dedup(table(spark, sf_dir, "documents"), size=3)
    return out.select("doc_id", F.col("kept").alias("text"), "n_lines", "n_removed")


MIX = mixing.Mix(budget_share=0.5, max_epochs=4, seed="mix-1",
                 weights={"domain": {"domain0": 4, "domain1": 3, "domain2": 2},
                          "lang": {"en": 3, "de": 2, "fr": 2}})


def _share_sql(name: str, src: str, parent: str, level: str, weight: str) -> str:
    """CTEs that fill ``level`` of the tree by repeated division: ``name``
    has the budget of each child."""
    over = f"PARTITION BY {parent}" if parent else ""
    keys = ", ".join(filter(None, [parent, level]))
    return f"""
{name}_w AS (SELECT *, CAST({weight} AS DOUBLE) AS w FROM {src}),
{name}_l AS (SELECT *, sum(w) OVER ({over}) - coalesce(sum(w) OVER ({over} ORDER BY cap / w, {level}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS wfrom,
               coalesce(sum(cap) OVER ({over} ORDER BY cap / w, {level}
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken FROM {name}_w),
{name} AS (SELECT {keys}, least(CAST(cap AS DOUBLE), w * max((budget - taken) / wfrom) OVER ({over})) AS budget
           FROM {name}_l)"""


OP9_SQL = f"""
WITH t AS (SELECT doc_id, 'domain' || coalesce(TRY_CAST(regexp_extract(source, '[0-9]+') AS BIGINT), 0) % 4 AS domain,
                  coalesce(lang, '') AS lang, coalesce(source, '') AS source, md5(coalesce(text, '')) AS body,
                  CAST(len(coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), [])) AS BIGINT) AS tokens
           FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS have, CAST(sum(tokens) * 4 AS BIGINT) AS cap
         FROM t WHERE tokens > 0 GROUP BY ALL),
d0 AS (SELECT domain, CAST(sum(cap) AS BIGINT) AS cap, CAST(floor((SELECT sum(have) FROM leaf) * 0.5) AS DOUBLE) AS budget
       FROM leaf GROUP BY domain),
{_share_sql('d1', 'd0', '', 'domain', "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END")},
l0 AS (SELECT leaf.domain, lang, CAST(sum(cap) AS BIGINT) AS cap, any_value(budget) AS budget
       FROM leaf JOIN d1 ON leaf.domain = d1.domain GROUP BY leaf.domain, lang),
{_share_sql('l1', 'l0', 'domain', 'lang', "CASE lang WHEN 'en' THEN 3 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END")},
s0 AS (SELECT leaf.domain, leaf.lang, source, cap, budget FROM leaf
       JOIN l1 ON leaf.domain = l1.domain AND leaf.lang = l1.lang),
{_share_sql('s1', 's0', 'domain, lang', 'source', '1')},
goal AS (SELECT leaf.*, CAST(floor(round(budget, 3)) AS BIGINT) // have AS epochs,
                CAST(floor(round(budget, 3)) AS BIGINT) % have AS rest
         FROM leaf JOIN s1 ON leaf.domain = s1.domain AND leaf.lang = s1.lang AND leaf.source = s1.source),
placed AS (SELECT t.*, epochs, rest, md5('mix-1:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || body) AS place
           FROM t JOIN goal g ON t.domain = g.domain AND t.lang = g.lang AND t.source = g.source WHERE tokens > 0),
upto AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) <= rest AS more FROM placed)
SELECT doc_id, domain, lang, source, tokens,
       CAST(unnest(range(epochs + CASE WHEN more THEN 1 ELSE 0 END)) AS INTEGER) AS epoch FROM upto
"""


@register("op9_mix_to_weights", OP9_SQL)
def q_mix(spark, sf_dir):
    """Documents by epoch that fill half of all tokens to the tree's weights."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_rows(docs, MIX, ["doc_id", "lang", "source"]).select(
        "doc_id", "domain", F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"), "tokens", "epoch")


def language_fold(doc_id) -> "F.Column":
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


@register("op6_language_id")
def q_language(spark, sf_dir):
    """Language of every document; learnt from the documents outside fold 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels, proto = langid.fit(docs.where(language_fold(F.col("doc_id")) != 0))
    return langid.predict(docs.select("doc_id", (language_fold(F.col("doc_id")) == 0).alias("held_out"), "text"),
                          labels, proto).select("doc_id", "held_out", "lang_pred", "score")


@register("op7_nearest_neighbours")
def q_nearest(spark, sf_dir):
    """Ten nearest found of every hundredth vector among all others."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), query="id % 100 = 0", k=10)


@register("op10_license_scan")
def q_licenses(spark, sf_dir):
    """License notices and texts found in every document (Dice of 0.8 or more)."""
    found = licenses.scan(table(spark, sf_dir, "documents"), threshold=0.8)
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.concat_ws(",", F.array_sort(F.array_distinct("matches.license"))).alias("licenses"),
        F.concat_ws(",", F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))).alias("spans"),
        F.coalesce(F.array_max("matches.dice"), F.lit(0.0)).alias("best_dice"))


@register("op3_pii_boosting")
def q_pii(spark, sf_dir):
    """Personal data in every document: base patterns and what the trees add
    (``n_added``, of which ``n_secret`` are secrets); ``flagged`` if there is any."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))

    def listed(col):
        return F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS],
        sha_list(listed("base")).alias("base_sha256"), F.concat_ws(",", listed("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == "secret")).cast("long").alias("n_secret"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"), (F.size("spans") > 0).alias("flagged"))


@register("op1_edit_token_counts")
def q_token_counts(spark, sf_dir):
    """Tokens of every document before and after its cleaning edits."""
    return tokencount.edited_counts(table(spark, sf_dir, "documents"))


@register("op13_minhash_near_dedup")
def q_minhash(spark, sf_dir):
    """Size of every document's set of 2-word shingles, its class at a Jaccard
    similarity of 0.8, and whether it is the one that stays."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, threshold=80)


OP11_SQL = """
WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
      FROM r a JOIN r ON a.id <> r.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id
      WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@register("op11_hard_negatives", OP11_SQL)
def q_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector: other labels, 80 to 100 % of a positive's score."""
    return negatives.mine(table(spark, sf_dir, "embeddings"), anchor="id % 100 = 0",
                          relabel="CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END",
                          positives=5, negatives=5, scale=256, window=(80, 100))


@register("op12_tokenizer_alignment")
def q_alignment(spark, sf_dir):
    """Groups and links of every document's tokens by two tokenizers, scored by
    the number of documents that hold the linked pairs."""
    return alignment.align(table(spark, sf_dir, "documents"))

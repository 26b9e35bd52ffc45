"""The corpus queries on the shared test tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (
    collocations,
    filter_audit,
    language,
    license_scan,
    line_quality,
    merge_rounds,
    merkle,
    ngram_join,
    packing,
    quality_rules,
    sentencepieces,
    sharding,
    warc,
)
from panelkit.llm.common import table
from panelkit.llm.registry import oracle_sql, queries, query  # noqa: F401

SHARD_BYTES = 1 << 20


def vocabulary_file(name: str) -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_TEMPLATES = ",\n".join(
    f"({t}, '{x.label}', {x.phrase}, {x.size}, [{_quoted(x.words)}])"
    for t, x in enumerate((*license_scan.PHRASES, *license_scan.NOTICES))
)


@query(
    rf"""
WITH template(t, label, phrase, k, words) AS (VALUES {_TEMPLATES}),
tgram AS (
  SELECT t, label, phrase, k, len(words) AS length, len(words) - k + 1 AS grams, pos,
         array_to_string(words[pos + 1 : pos + k], ' ') AS gram
  FROM template, LATERAL (SELECT unnest(range(len(words) - k + 1)) AS pos)),
doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
dgram AS (
  SELECT doc_id, k, place, array_to_string(words[place + 1 : place + k], ' ') AS gram
  FROM doc, (VALUES (2), (4)) AS s(k), LATERAL (SELECT unnest(range(len(words) - k + 1)) AS place)),
diag AS (
  SELECT doc_id, t, label, phrase, length, grams, place - pos AS diagonal, list(DISTINCT pos) AS votes,
         min(place) AS start, max(place) + max(dgram.k) AS stop
  FROM dgram JOIN tgram ON dgram.gram = tgram.gram AND dgram.k = tgram.k
  GROUP BY ALL),
step AS (
  SELECT *, CASE WHEN NOT phrase AND diagonal - lag(diagonal) OVER w <= {license_scan.NEAR} THEN 0 ELSE 1 END AS begins
  FROM diag WINDOW w AS (PARTITION BY doc_id, t ORDER BY diagonal)),
island AS (
  SELECT *, sum(begins) OVER (PARTITION BY doc_id, t ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS isle FROM step),
span AS (
  SELECT doc_id, t, label, phrase, length, grams, isle, len(list_distinct(flatten(list(votes)))) AS votes, min(start) AS start, max(stop) AS stop
  FROM island GROUP BY ALL),
good AS (
  SELECT *, least(CAST(votes AS DOUBLE) / grams, 1.0) AS cover FROM span
  WHERE CASE WHEN phrase THEN votes = grams
        ELSE least(CAST(votes AS DOUBLE) / grams, 1.0) >= {license_scan.COVERED} AND stop - start <= 2 * length END)
SELECT doc.doc_id, CAST(any_value(len(words)) AS BIGINT) AS n_words,
       count(*) FILTER (WHERE phrase) AS n_base,
       CAST(min(start) FILTER (WHERE phrase) AS BIGINT) AS first_word,
       CAST(max(start) FILTER (WHERE phrase) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       count(*) FILTER (WHERE NOT phrase) AS n_spans,
       CAST(coalesce(max(cover), 0) AS DOUBLE) AS score
FROM doc LEFT JOIN good ON doc.doc_id = good.doc_id
GROUP BY doc.doc_id"""
)
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


_RULE_RATES = ",\n         ".join(
    f"CAST(sum(CASE WHEN {sql} THEN 1 ELSE 0 END) AS DOUBLE) AS n_{r}" for r, sql in quality_rules.RULES.items()
)
_RULE_STATS = ", ".join(
    f"avg(n_{r} / n) AS m_{r}, var_pop(n_{r} / n) AS v_{r}" for r in quality_rules.RULES
)
_LOW, _HIGH = quality_rules.PRIOR_LIMITS
_RULE_WEIGHTS = ", ".join(
    f"m_{r}, CASE WHEN v_{r} > 0 THEN least({_HIGH}, greatest({_LOW}, m_{r} * (1 - m_{r}) / v_{r} - 1))"
    f" ELSE {_HIGH} END AS w_{r}"
    for r in quality_rules.RULES
)
_RULE_BAD = ", ".join(
    f"(n_{r} + m_{r} * w_{r}) / (n + w_{r}) >= {quality_rules.HOST_LIMIT} AS bad_{r}" for r in quality_rules.RULES
)
_RULE_FAILED = " OR ".join(f"({sql}) AND bad_{r}" for r, sql in quality_rules.RULES.items())


@query(
    rf"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
tri AS (
  SELECT doc_id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] AS gram
  FROM doc, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS pos)),
often AS (SELECT doc_id, gram FROM tri GROUP BY ALL HAVING count(*) > 1),
marked AS (
  SELECT tri.doc_id, count(DISTINCT pos + d) AS n_repeat_words
  FROM tri JOIN often USING (doc_id, gram), (VALUES (0), (1), (2)) AS s(d) GROUP BY 1),
measured AS (
  SELECT doc.doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(lines) AS BIGINT) AS n_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM doc LEFT JOIN marked USING (doc_id)),
host AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n,
         {_RULE_RATES}
  FROM measured GROUP BY 1),
stats AS (SELECT {_RULE_STATS} FROM host),
prior AS (SELECT {_RULE_WEIGHTS} FROM stats),
verdict AS (SELECT source, {_RULE_BAD} FROM host, prior),
judged AS (
  SELECT m.*, {quality_rules.BASE} AS base_failed, coalesce({_RULE_FAILED}, false) AS host_failed
  FROM measured m JOIN verdict v ON m.source IS NOT DISTINCT FROM v.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed,
       NOT (base_failed OR host_failed) AS kept
FROM judged"""
)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def _tree_sql(name: str, source: str) -> str:
    """Common table expressions that make ``name`` (doc_id, root, shown, leaf, secs) of texts."""
    return rf"""
{name}_leaf AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)), lambda p: list_transform(
           string_split(replace(replace(replace(p, '. ', '.' || chr(10)), '! ', '!' || chr(10)),
                                '? ', '?' || chr(10)), chr(10)),
           lambda s: substr(md5(s), 1, 16))) AS leaves
  FROM {source}),
{name}_par AS (
  SELECT doc_id, n, leaf, substr(md5(array_to_string(leaf, ',')), 1, 16) AS node, len(leaves) AS total
  FROM {name}_leaf, LATERAL (SELECT unnest(leaves) AS leaf, unnest(range(len(leaves))) AS n)),
{name}_cut AS (
  SELECT *, coalesce(sum(CASE WHEN node[1] IN ('0', '1', '2', '3') THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sec
  FROM {name}_par),
{name}_sec AS (
  SELECT doc_id, sec, min(n) AS first,
         substr(md5(string_agg(node, ';' ORDER BY n)), 1, 16) AS hash,
         string_agg(array_to_string(leaf, ','), ';' ORDER BY n) AS shown,
         flatten(list(leaf ORDER BY n)) AS leaf
  FROM {name}_cut GROUP BY doc_id, sec),
{name} AS (
  SELECT doc_id, sha256(string_agg(hash, '|' ORDER BY sec)) AS root, string_agg(shown, '|' ORDER BY sec) AS shown,
         list_distinct(flatten(list(leaf))) AS leaf, list(hash ORDER BY sec) AS secs, list(first ORDER BY sec) AS firsts
  FROM {name}_sec GROUP BY doc_id)"""


def _near_sql(a: str, b: str) -> str:
    shared = f"len(list_intersect({a}.leaf, {b}.leaf))"
    return (
        f"CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE ELSE CAST({shared} AS DOUBLE)"
        f" / (len({a}.leaf) + len({b}.leaf) - {shared}) END"
    )


@query(
    rf"""
WITH plain AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
paired AS (
  SELECT doc_id, text, length(text) // 4 AS tail,
         coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM plain),
changed AS (
  SELECT doc_id, substr(text, 1, length(text) - tail) || substr(next, 1, tail) AS text FROM paired),
{_tree_sql("own", "plain")}, {_tree_sql("other", "changed")}
SELECT p.doc_id, CAST(length(p.text) AS BIGINT) AS n_chars, sha256(c.text) AS edited_sha256,
       own.root || ':' || own.shown AS fingerprint, other.root || ':' || other.shown AS edited_fingerprint,
       {_near_sql("own", "other")} AS near_edited, {_near_sql("own", "after")} AS near_next,
       CASE WHEN own.root <> other.root THEN
         (SELECT CAST(min(f) AS BIGINT) FROM (SELECT unnest(own.firsts) AS f, unnest(own.secs) AS h)
          WHERE NOT list_contains(other.secs, h)) END AS edited_from
FROM paired p JOIN changed c USING (doc_id) JOIN own ON own.doc_id = p.doc_id JOIN other ON other.doc_id = p.doc_id
     JOIN own AS after ON after.doc_id = p.next_id"""
)
def op3_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_edit(table(spark, sf_dir, "documents"))


@query(
    r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 4], ' ') AS g
  FROM doc, LATERAL (SELECT unnest(range(1, greatest(len(words) - 3, CASE WHEN len(words) > 0 THEN 2 ELSE 1 END))) AS pos)),
amount AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN amount p ON a = p.doc_id JOIN amount q ON b = q.doc_id
  WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
reach AS (
  SELECT doc_id, doc_id AS root FROM doc
  UNION
  SELECT link.b AS doc_id, reach.root FROM reach JOIN link ON link.a = reach.doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id
FROM reach LEFT JOIN amount USING (doc_id) GROUP BY doc_id"""
)
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"))


@query()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(
        table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_multi_50k.tiktoken")
    )


@query()
def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    """
WITH page AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
held AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS holder
  FROM page)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN holder = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM held"""
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))


@query(
    f"""
WITH doc AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
         substr(CAST(CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS BIT) AS VARCHAR), 5) AS bits
  FROM documents),
level AS (
  SELECT doc_id, n_bytes, depth, substr(bits, 1, depth) AS shard,
         sum(n_bytes) OVER (PARTITION BY depth, substr(bits, 1, depth)) AS shard_bytes
  FROM doc, (SELECT unnest(range({sharding.BITS + 1})) AS depth)),
fit AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS r
  FROM level WHERE shard_bytes <= {SHARD_BYTES} OR depth = {sharding.BITS})
SELECT doc_id, n_bytes, shard, CAST(depth AS INTEGER) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes,
       shard_bytes <= {SHARD_BYTES} AS fits
FROM fit WHERE r = 1"""
)
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARD_BYTES).select(
        "doc_id", "n_bytes", "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes", "fits"
    )


@query(
    r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
failed AS (
  SELECT doc_id, part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
         100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text),
         regexp_matches(text, '[#$%&*|]'), doc_id > min(doc_id) OVER (PARTITION BY text)] AS fails,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = doc.doc_id AND quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = doc.doc_id AND toxic = 1) AS toxic
  FROM doc),
letter(i, f) AS (VALUES (1, 'A'), (2, 'B'), (3, 'C'), (4, 'D'), (5, 'E')),
perm AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS places, a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
mask AS (
  SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY ALL),
step AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, places, places[s] AS own FROM perm, LATERAL (SELECT unnest(range(1, 6)) AS s)),
walk AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS fails_own,
         len(list_filter(places[1:step - 1], lambda x: fails[x])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AS only_one
  FROM mask, step),
counted AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (WHERE NOT gone AND NOT fails_own) AS kept,
         sum(n) FILTER (WHERE NOT gone AND fails_own) AS removed,
         sum(n) FILTER (WHERE gone AND fails_own) AS redundant,
         sum(n) FILTER (WHERE fails_own AND only_one) AS unique_fails,
         sum(n) FILTER (WHERE NOT gone AND fails_own AND good) AS good_lost,
         sum(n) FILTER (WHERE NOT gone AND fails_own AND toxic) AS toxic_lost
  FROM walk GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM counted"""
)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    rf"""
WITH RECURSIVE line AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS line
  FROM documents),
piece AS (SELECT lang, regexp_extract_all(line, '[^\x20\x09]+') AS w FROM line),
gram AS (
  SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f
  FROM piece, (VALUES (1), (2), (3)) AS s(k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i) GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM gram WHERE k = 1 GROUP BY 1),
cand AS (SELECT * FROM gram WHERE k > 1 AND f >= {collocations.MIN_COUNT}),
cut AS (
  SELECT c.lang, c.k, c.g, c.f AS a, i, x.f AS l, y.f AS r,
         1000000::HUGEINT * c.f::HUGEINT * c.f::HUGEINT // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM cand c, LATERAL (SELECT unnest(range(1, c.k)) AS i)
  JOIN gram x ON x.lang = c.lang AND x.g = c.g[1:i] JOIN gram y ON y.lang = c.lang AND y.g = c.g[i + 1:c.k]),
least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1),
inside AS (
  SELECT s.lang, s.g, max(t.f) AS top, max(t.f) FILTER (WHERE t.g[1:2] = s.g) AS out,
         max(t.f) FILTER (WHERE t.g[2:3] = s.g) AS into
  FROM cand s JOIN cand t ON s.lang = t.lang AND s.k = 2 AND t.k = 3 AND (t.g[1:2] = s.g OR t.g[2:3] = s.g) GROUP BY 1, 2),
inner_node AS (
  SELECT c.lang, c.g, c.f FROM cand c JOIN inside i ON c.lang = i.lang AND c.g = i.g WHERE i.out = c.f AND i.into = c.f),
prev AS (
  SELECT u.lang, u.g, p.g AS before FROM inner_node u JOIN cand t ON t.lang = u.lang AND t.k = 3 AND t.g[2:3] = u.g AND t.f = u.f
  JOIN inner_node p ON p.lang = u.lang AND p.g = t.g[1:2]),
walk AS (
  SELECT lang, g, g AS root, 0 AS d FROM inner_node
  UNION ALL
  SELECT walk.lang, walk.g, prev.before AS root, d + 1 FROM walk JOIN prev ON prev.lang = walk.lang AND prev.g = walk.root),
rooted AS (SELECT lang, g, arg_max(root, d) AS root FROM walk GROUP BY 1, 2),
sized AS (SELECT lang, g, count(*) OVER (PARTITION BY lang, root) + 3 AS path_words FROM rooted),
kept AS (
  SELECT x.lang, array_to_string(x.g, ' ') AS phrase, a, l, r, score,
         CASE WHEN x.k = 2 THEN 2 ELSE coalesce(q.path_words, p.path_words, 3) END AS path_words
  FROM least x LEFT JOIN inside i ON x.k = 2 AND i.lang = x.lang AND i.g = x.g
  LEFT JOIN sized p ON x.k = 3 AND p.lang = x.lang AND p.g = x.g[1:2]
  LEFT JOIN sized q ON x.k = 3 AND q.lang = x.lang AND q.g = x.g[2:3]
  WHERE i.top IS NULL OR 100 * i.top < {collocations.SHARE} * a),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, CAST(path_words AS BIGINT) AS path_words
FROM placed JOIN total USING (lang) WHERE rank <= {collocations.TOP}"""
)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@query()
def op13_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_rounds.digests(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))

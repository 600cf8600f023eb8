"""The registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwh.llm import (
    ann, chat, jaccard, langid, license_rules, license_scan, mixing, negatives, packing, periodic, quality_model,
    quality_rules, url_filter, warc,
)
from labwh.llm.common import fold, fresh_path, staged, words_of

URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)

PROBE = r"\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens; one row per piece."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what the mix takes of them."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs, used=fold(F.col("doc_id"), 5) != 0)
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return langid.predict(docs, model).select("doc_id", held_out, "lang_pred", "score")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives, normalised, and read back by index."""
    records = warc.archive(_table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
  CASE WHEN payload_bytes >= 1000 AND keeper > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND keeper > page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two thirds of the labels."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scores = quality_model.classify(_table(spark, sf_dir, "documents"), labels, used=fold(F.col("doc_id"), 3) != 1)
    return scores.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth embedding among all others."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document, by three-word shingles at 0.9."""
    return jaccard.join(_table(spark, sf_dir, "documents"), jaccard.Similarity(percent=90, words=3))


OP8_SQL = r"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS rid, doc_id,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT rid, doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
sets AS (SELECT rid, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS s
  FROM w),
el AS (SELECT rid, len(s) AS n, unnest(s) AS e FROM sets),
common AS (SELECT a.rid AS a, b.rid AS b, a.n AS an, b.n AS bn, count(*) AS n_both FROM el a JOIN el b ON a.e = b.e
  AND a.rid < b.rid AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * n_both >= 90 * (an + bn - n_both)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM sets s JOIN reach ON reach.a = s.rid JOIN sets t ON t.rid = reach.b GROUP BY s.rid, s.doc_id, len(s.s)
"""


def op8_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and number of linked documents of every document, by three-word shingles at 0.9."""
    return jaccard.count_links(_table(spark, sf_dir, "documents"), jaccard.Similarity(percent=90, words=3))


OP8_LINKS_SQL = OP8_SQL.partition("reach(a, b)")[0].rstrip().rstrip(",") + """
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, count(edges.b) AS n_links
FROM sets s LEFT JOIN edges ON edges.a = s.rid GROUP BY s.rid, s.doc_id, len(s.s)
"""


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe: formatted, written, read back and digested."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    template = chat.ChatTemplate()
    formatted = chat.format_conversations(rows.unionByName(probe), template)
    written = staged(formatted.select("conv_id", "formatted", "loss_spans", "valid"), "chat-formatted")
    read = chat.parse(written, template)
    loss = chat.under_mask(F.col("formatted"), F.col("loss_spans"), template)
    whole = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", "formatted", "valid", F.size("parsed").cast("long").alias("n_turns"),
                       whole.alias("whole"), loss.alias("loss")).select(
        "conv_id", "n_turns", F.sha2("whole", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


OP6_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}'
  UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
esc AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '<turn>', '\a'), '</turn>', '\b') AS etext,
    replace(replace(replace(replace(role, '\', '\\'), '<turn>', '\a'), '</turn>', '\b'), chr(10), '\c') AS erole,
    coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), 'start') AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) = 1 AS last_turn
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(6 + length(erole) + 1 + length(etext) + 8)::BIGINT AS formatted_chars,
  bool_and(CASE before WHEN 'start' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
    WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END)
    AND bool_or(last_turn AND role = 'assistant') AS valid
FROM esc GROUP BY conv_id
"""


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the distribution divergence for every document."""
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_R = quality_rules.DivergenceRules()
OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, lang, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
pos AS (SELECT rid, lang, words, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
tri AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n
        FROM pos WHERE i <= len(words) - 2),
rep AS (SELECT rid, count(DISTINCT j) AS n_repeat_words
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM tri WHERE n > 1) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
df AS (SELECT lang, word, count(DISTINCT rid) AS n FROM pos WHERE length(word) <= {_R.max_word_chars} GROUP BY ALL),
both_df AS (SELECT lang, word, n FROM df WHERE lang IS NOT NULL
            UNION ALL SELECT '*', word, sum(n) FROM df GROUP BY word),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r
        FROM both_df QUALIFY r <= {_R.common_words}),
base AS (
  SELECT d.rid, doc_id, d.lang, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, length(text) AS n,
    [length(regexp_replace(text, '\P{{Ll}}+', '', 'g')), length(regexp_replace(text, '[^\x20\x09-\x0D]+', '', 'g')),
     length(regexp_replace(text, '\P{{Lu}}+', '', 'g')), length(regexp_replace(text, '[^0-9]+', '', 'g')),
     length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')),
     length(regexp_replace(regexp_replace(text, '[\p{{Ll}}\p{{Lu}}]+', '', 'g'), '\P{{L}}+', '', 'g'))] AS c6,
    CASE WHEN d.lang IN (SELECT lang FROM top) THEN d.lang ELSE '*' END AS list_lang
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)),
hist AS (
  SELECT *, list_transform(list_concat(c6, [n - list_sum(c6)]), lambda x: CASE WHEN n > 0 THEN x / n ELSE 0.0 END) AS classes
  FROM base),
hits AS (SELECT rid, r, count(*) AS c FROM pos JOIN base USING (rid) JOIN top ON top.lang = list_lang AND top.word = pos.word
         GROUP BY ALL),
slots AS (SELECT rid, n_words, unnest(range(1, {_R.common_words + 1})) AS r FROM base),
shares AS (SELECT rid, list(CASE WHEN n_words > 0 THEN coalesce(c, 0) / n_words ELSE 0.0 END ORDER BY r) AS s
           FROM slots LEFT JOIN hits USING (rid, r) GROUP BY rid),
stats AS (SELECT h.*, list_concat(s, [CASE WHEN n_words > 0 THEN 1 - list_sum(s) ELSE 0.0 END]) AS ws
          FROM hist h JOIN shares USING (rid)),
cells AS (SELECT rid, lang, 'c' AS kind, unnest(classes) AS v, generate_subscripts(classes, 1) AS k FROM stats WHERE n_words >= {_R.min_words}
          UNION ALL SELECT rid, lang, 'w', unnest(ws), generate_subscripts(ws, 1) FROM stats WHERE n_words >= {_R.min_words}),
ref AS (SELECT lang, kind, k, avg(v) AS q FROM cells WHERE lang IN
          (SELECT lang FROM stats WHERE n_words >= {_R.min_words} GROUP BY lang HAVING count(*) >= {_R.min_reference}) GROUP BY ALL
        UNION ALL SELECT '*', kind, k, avg(v) FROM cells GROUP BY kind, k),
js AS (SELECT rid, kind, sqrt(greatest(0, sum((CASE WHEN v > 0 THEN v * log2(2 * v / (v + q)) ELSE 0 END
              + CASE WHEN q > 0 THEN q * log2(2 * q / (v + q)) ELSE 0 END) / 2))) AS dist
       FROM cells JOIN ref USING (kind, k)
       WHERE ref.lang = CASE WHEN cells.lang IN (SELECT lang FROM ref) THEN cells.lang ELSE '*' END GROUP BY ALL),
verdict AS (SELECT rid, bool_or(dist > CASE kind WHEN 'c' THEN {_R.max_class_distance} ELSE {_R.max_word_distance} END) AS far
            FROM js GROUP BY rid)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words) AS base_failed,
  NOT (n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words)
    AND NOT coalesce(far, false) AS kept
FROM stats LEFT JOIN verdict USING (rid)
"""


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, then the model's verdict, for every page's url."""
    return url_filter.classify(_table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def _op10_sql() -> str:
    model = url_filter.fit()
    size = len(model.weights)
    rules = sorted(URL_RULES, key=lambda r: -len(r.name))

    def cases(value: Callable[[url_filter.Rule], str]) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'"
            for r in rules) + " END"

    def grams(text: str, salt: int) -> str:
        return f"""list_distinct(list_transform(range(1, length({text}) - 1), lambda i: (unicode(substr({text}, i, 1)) * 961
          + unicode(substr({text}, i + 1, 1)) * 31 + unicode(substr({text}, i + 2, 1)) + {salt}) % {size}))"""

    return rf"""
WITH weights AS (SELECT [{", ".join(map(repr, model.weights))}] AS w),
u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
p AS (SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.UPPER.lower()}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT *, '^' || host || '$' AS ht, '^' || translate(path, '0123456789', '0000000000') || '$' AS pt FROM p),
b AS (SELECT *, list_distinct(list_concat({grams("ht", url_filter.SALTS["host"])}, {grams("pt", url_filter.SALTS["path"])})) AS buckets FROM f),
s AS (SELECT page_id, host, path, {model.bias!r} + coalesce(list_sum(list_transform(buckets, lambda x: w[x + 1])), 0) AS logit
      FROM b, weights)
SELECT page_id, host, path, {cases(lambda r: r.name)} AS rule,
  coalesce({cases(lambda r: r.verdict)}, CASE WHEN 1 / (1 + exp(-logit)) >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM s
"""


def with_repeats(docs: DataFrame) -> DataFrame:
    """Every tenth document by a hash h of its id gets a periodic tail: its word i >= a becomes word a + (i - a) % p.
    Documents without id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words_of(F.col("text"))).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    rows = rows.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    tail = F.transform(F.sequence(F.col("a"), n - 1), lambda i: F.get("w", F.col("a") + (i - F.col("a")) % F.col("p")))
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of them given a periodic tail."""
    found = periodic.find_runs(with_repeats(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", "exponent_milli",
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and licenses in every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections")


def _op12_sql() -> str:
    base, rules = license_scan._rules(license_rules.PHRASES, license_rules.LICENSES)
    kinds = license_scan.KINDS
    rows = ",\n".join(
        f"({i}, '{s.label}', '{s.kind}', {kinds.index(s.kind) + 1 if s.kind in kinds else 0}, {license_scan.WORTH.get(s.kind, 0.0)},"
        f" '{s.keyword}', '{s.regex.replace('++', '+')}')" for i, s in enumerate([*base, *rules]))
    return rf"""
WITH rules(rule, label, kind, rank, worth, keyword, regex) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.UPPER.lower()}'), '{license_scan.BETWEEN_WORDS}'),
        lambda x: x <> '') AS words FROM documents),
t AS (SELECT rid, words, array_to_string(list_transform(words, lambda w, i: ' ' || (i - 1) || ':' || w || ' '), '') AS text FROM d),
hits AS (SELECT rid, rule, label, kind, rank, worth::DOUBLE AS worth,
           unnest(regexp_extract_all(text, regex)) AS hit FROM t JOIN rules ON list_contains(words, keyword)),
spans AS (SELECT *, split_part(ltrim(hit), ':', 1)::BIGINT AS s,
            split_part(ltrim(hit), ':', 1)::BIGINT + length(hit) - length(replace(hit, ':', '')) AS e FROM hits),
marked AS (SELECT *, rank > 0 AND EXISTS (
             SELECT 1 FROM spans o WHERE o.rid = x.rid AND o.rank > 0 AND o.rank <= x.rank AND o.s <= x.s AND o.e >= x.e AND o.rule <> x.rule
               AND (o.s < x.s OR o.e > x.e OR o.rank < x.rank OR o.rule < x.rule)) AS inside FROM spans x),
sums AS (SELECT rid, count(*) FILTER (rank = 0) AS n_base, min(s) FILTER (rank = 0) AS first_word, max(s) FILTER (rank = 0) AS last_word,
           array_to_string(list_sort(list_distinct(list(label) FILTER (rank = 0))), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list(label) FILTER (NOT inside))), ',') AS labels,
           max(worth) FILTER (NOT inside) AS score, count(*) FILTER (rank > 0 AND NOT inside) AS n_detections
         FROM marked GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score,
  coalesce(n_detections, 0) AS n_detections
FROM d LEFT JOIN sums USING (rid)
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding's positives among all rows."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP13_SQL = """
WITH r AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.rid AS arid, a.vec_id AS anchor_id, a.label AS own, c.rid, c.vec_id, c.label,
            list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::BIGINT AS score
          FROM r a, r c WHERE a.vec_id % 50 = 0 AND a.rid <> c.rid),
pos AS (SELECT *, row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id) AS r FROM pairs WHERE own = label QUALIFY r <= 5),
neg AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
          row_number() OVER (PARTITION BY p.arid, p.rid ORDER BY n.score DESC, n.vec_id) AS rank
        FROM pos p JOIN pairs n ON n.arid = p.arid AND n.own <> n.label
          AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score QUALIFY rank <= 3)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_mixing": op2_mixing,
    "op3_language_id": op3_language_id,
    "op4_warc": op4_warc,
    "op5_permutation_index": op5_permutation_index,
    "op6_chat_format": op6_chat_format,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_jaccard_join": op8_jaccard_join,
    "op8_jaccard_links": op8_jaccard_links,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_license_scan": op12_license_scan,
    "op13_hard_negatives": op13_hard_negatives,
}


def oracles() -> dict[str, str]:
    return {"op4_warc": OP4_SQL, "op6_chat_format": OP6_SQL, "op8_jaccard_join": OP8_SQL, "op8_jaccard_links": OP8_LINKS_SQL,
            "op9_quality_rules": OP9_SQL, "op10_url_filter": _op10_sql(), "op12_license_scan": _op12_sql(),
            "op13_hard_negatives": OP13_SQL}

"""The queries that apply the operators to their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import chat, language, lexical, mixing, mtree, neardup, neighbours, packing, prefixes, quality, secrets, tokenfiles, toxicity
from evenkeel.llm.common import table
from evenkeel.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = lambda spark, folder: fn(pin_utc(spark), folder)
    return fn


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "padded")


@query
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = tokenfiles.write_token_files(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        tokenfiles.token_folder(spark), end_id=2)
    docs = tokenfiles.read_token_files(spark, files)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, folder, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *[f"quality.{n}" for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
        *[F.round(f"quality.{n}", 6).alias(n) for n in ("word_distance", "class_distance")])


def parts_sql(p: str, q: str) -> str:
    """A bin's part of twice the Jensen-Shannon divergence."""
    half = lambda a, b: f"CASE WHEN {a} > 0 THEN ({a}) * log2(2 * ({a}) / (({a}) + ({b}))) ELSE 0 END"
    return f"({half(p, q)} + {half(q, p)})"


ORACLE["op3_quality_rules"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         regexp_replace(text, '[a-z\x20\x09-\x0D\x{{DF}}-\x{{FF}}]+', '', 'g') AS rare,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS times
  FROM (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3))
), covered AS (
  SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM windows WHERE times > 1) GROUP BY rid
), counts AS (
  SELECT rid, doc_id, lang, text, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) AS chars,
         length(regexp_replace(rare, '[^\p{{Lu}}]+', '', 'g')) AS c0, length(regexp_replace(rare, '[^0-9]+', '', 'g')) AS c1,
         length(regexp_replace(rare, '[^#*$%&|<>]+', '', 'g')) AS c2,
         length(regexp_replace(rare, '[^.,;:!?''"()/@_\-]+', '', 'g')) AS c3,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM words LEFT JOIN covered USING (rid)
), bins AS (
  SELECT rid, lang, chars, unnest([c0, c1, c2, c3, chars - word_chars, word_chars - c0 - c1 - c2 - c3]) AS n,
         unnest(range(6)) AS bin FROM counts
), class_shares AS (
  SELECT lang, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM bins WHERE lang IS NOT NULL GROUP BY lang, bin
), tokens AS (
  SELECT rid, lang, lower(unnest(w)) AS word FROM counts
), listed AS (
  SELECT lang, word, n / total AS q
  FROM (SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place,
               sum(count(*)) OVER (PARTITION BY lang) AS total
        FROM tokens WHERE lang IS NOT NULL GROUP BY lang, word)
  WHERE place <= 40
), others AS (
  SELECT lang, 1 - sum(q) AS other FROM listed GROUP BY lang
), met AS (
  SELECT rid, l.lang, sum({parts_sql("t.n::DOUBLE / c.n_words", "l.q")}) AS part, sum(t.n::DOUBLE / c.n_words) AS p, sum(l.q) AS q
  FROM (SELECT rid, word, count(*) AS n FROM tokens GROUP BY rid, word) t
  JOIN listed l USING (word) JOIN counts c USING (rid) GROUP BY rid, l.lang
), word_distances AS (
  SELECT rid, min(sqrt(least(1, greatest(0, (coalesce(m.part, 0) + {parts_sql("1 - coalesce(m.p, 0)", "o.other")}
                                             + 1 - o.other - coalesce(m.q, 0)) / 2)))) AS d
  FROM (SELECT rid FROM counts) CROSS JOIN others o LEFT JOIN met m USING (rid, lang) GROUP BY rid
), class_distances AS (
  SELECT rid, min(d) AS d FROM (
    SELECT b.rid, s.lang, sqrt(least(1, greatest(0, sum({parts_sql("b.n::DOUBLE / b.chars", "s.q")}) / 2))) AS d
    FROM (SELECT rid, bin, n, chars FROM bins) b JOIN class_shares s USING (bin) JOIN others USING (lang) WHERE b.chars > 0 GROUP BY b.rid, s.lang) GROUP BY rid
), judged AS (
  SELECT c.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words >= 50 AND chars >= 200 THEN wd.d END AS wd, CASE WHEN n_words >= 50 AND chars >= 200 THEN cd.d END AS cd
  FROM counts c LEFT JOIN word_distances wd USING (rid) LEFT JOIN class_distances cd USING (rid)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, c2::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(wd <= {quality.MOST_WORD_DISTANCE}, true) AND coalesce(cd <= {quality.MOST_CLASS_DISTANCE}, true) AS kept,
       round(wd, 6) AS word_distance, round(cd, 6) AS class_distance
FROM judged
"""


@query
def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", *[f"mix.{n}" for n in mixing.MIX])


ORACLE["op8_source_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
             / 4503599627370496::DOUBLE)
         / CASE WHEN size > 0 THEN size::DOUBLE / (size + len(regexp_extract_all(text, '[#*$%&|<>]'))) ELSE 1 END AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM keyed GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
             ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, max(level) OVER () * weight) AS target FROM levels
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets
), ordered AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs,
         round(p.target - p.epochs * p.source_size) AS open,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k.size AS before
  FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target,
       (epochs * size + greatest(0, least(size, open - before)))::BIGINT AS taken
FROM ordered
"""

#: A conversation that holds marks of other templates.
PLANTED = ("SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
           "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")


@query
def op1_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.sql(PLANTED))
    read = chat.read_windows(chat.format_conversations(turns))
    text = F.array_join(F.transform("own", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select("conv_id", F.struct(
        "window", F.size("own").alias("turns"), text.alias("text"), F.array_join("learnt", "").alias("learnt"),
        F.length("formatted").alias("chars")).alias("w"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))
    joined = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    total = lambda name: F.aggregate("w", F.lit(0).cast("bigint"), lambda a, x: a + x[name])
    return whole.select(
        "conv_id", total("turns").alias("n_turns"), F.sha2(joined("text"), 256).alias("turns_sha256"),
        F.length(joined("learnt")).cast("bigint").alias("loss_chars"), F.sha2(joined("learnt"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"), F.size("w").cast("bigint").alias("n_windows"))


ORACLE["op1_chat_windows"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), blocks AS (
  SELECT *, '<|turn:' || role || '|>' || regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')
            || '<|end|>' AS block
  FROM turns
), sized AS (
  SELECT *, ceil(strlen(block) / 4)::BIGINT AS tokens, length(block) AS chars FROM blocks
), summed AS (
  SELECT *, sum(tokens) OVER o AS upto, row_number() OVER o AS pos FROM sized
  WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
), system AS (
  SELECT conv_id, arg_min(pos, pos) AS sys_at, arg_min(tokens, pos) AS sys_tokens, arg_min(chars, pos) AS sys_chars
  FROM summed WHERE role = 'system' GROUP BY conv_id
), roomy AS (
  SELECT s.*, sys_at, sys_tokens, sys_chars, greatest(1, 832 - coalesce(sys_tokens, 0)) AS room, upto - tokens AS before
  FROM summed s LEFT JOIN system USING (conv_id)
), cells AS (
  SELECT *, greatest(1, floor(room * 3 / 4)) AS stride, floor(before / greatest(1, floor(room * 3 / 4))) AS cell FROM roomy
), marked AS (
  SELECT *, upto > (cell + 1) * stride AND before > min(before) OVER c AND upto - min(before) OVER c > room AS alone
  FROM cells WINDOW c AS (PARTITION BY conv_id, cell)
), opened AS (
  SELECT *, coalesce(lag(cell) OVER o <> cell OR lag(alone) OVER o <> alone, true) AS opens
  FROM marked WINDOW o AS (PARTITION BY conv_id ORDER BY pos)
), windowed AS (
  SELECT *, sum(opens::BIGINT) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS win FROM opened
), seen AS (
  SELECT *, max(CASE WHEN pos = sys_at THEN win END) OVER (PARTITION BY conv_id) AS sys_win,
         lead(opens, 1) OVER o AND lead(before, 1) OVER o - before <= 192 AND pos IS DISTINCT FROM sys_at AS copy1,
         lead(opens, 2) OVER o AND lead(before, 2) OVER o - before <= 192 AND pos IS DISTINCT FROM sys_at AS copy2
  FROM windowed WINDOW o AS (PARTITION BY conv_id ORDER BY pos)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE WHEN copy1 THEN chars ELSE 0 END + CASE WHEN copy2 THEN chars ELSE 0 END
           + CASE WHEN opens AND win > sys_win THEN sys_chars ELSE 0 END)::BIGINT AS formatted_chars,
       (max(win) + 1)::BIGINT AS n_windows
FROM seen GROUP BY conv_id
"""


@query
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), size=3, percent=85)


ORACLE["op5_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words
), classes AS (
  SELECT min(doc_id) AS node, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s
), items AS (
  SELECT node, n, unnest(s) AS item FROM classes
), links AS (
  SELECT a.node AS u, b.node AS v FROM items a JOIN items b ON a.item = b.item AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges AS (
  SELECT u, v FROM links UNION SELECT v, u FROM links
), reach AS (
  SELECT node, node AS other FROM classes
  UNION SELECT r.node, e.v FROM reach r JOIN edges e ON r.other = e.u
), labels AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
), members AS (
  SELECT x.doc_id, len(x.s) AS n_shingles, coalesce(l.component_id, x.doc_id) AS component_id
  FROM (SELECT doc_id, list_sort(s) AS s FROM sets) x
  LEFT JOIN classes c ON x.s = c.s LEFT JOIN labels l ON c.node = l.node
)
SELECT doc_id, n_shingles::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM members
"""


def fold_of(folds: int):
    """Remainder of the CRC-32 of the id as text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", fold_of(5) == 0)
    model = language.fit_languages(docs.where(~F.col("held_out")))
    return language.identify_languages(docs, model, keep=["doc_id", "held_out"])


@query
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, folder, "documents"), keep=["doc_id"])
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(of("assign", "access", "hex")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", fold_of(3) == 1)
    lexicon = toxicity.fit_lexicon(docs.where(~F.col("held_out")), table(spark, folder, "labels"))
    scored = toxicity.score_toxicity(docs, lexicon, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = neighbours.valid_vectors(table(spark, folder, "embeddings"))
    return neighbours.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@query
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


ORACLE["op13_lexical_search"] = r"""
WITH listed AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), asked AS (
  SELECT iid, item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS iid, item_id, text FROM benchmark)
), totals AS (
  SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS total FROM listed
), postings AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM listed) GROUP BY rid, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY term, docs
), lengths AS (
  SELECT rid, doc_id, 100 - 75 + ((75 * len(terms) * docs) // total)::BIGINT AS m FROM listed, totals WHERE len(terms) > 0
), scored AS (
  SELECT a.iid, a.item_id, l.doc_id, l.rid, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * l.m)))::BIGINT AS score
  FROM asked a JOIN postings p USING (term) JOIN weights w USING (term) JOIN lengths l USING (rid)
  GROUP BY a.iid, a.item_id, l.doc_id, l.rid
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


@query
def op11_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = mtree.quantised(table(spark, folder, "embeddings"), scale=1024.0)
    return mtree.exact_top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


ORACLE["op11_exact_top_k"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return prefixes.prefix_trie(prefixes.share_openings(prefixes.sequences(turns), families=5, most=8))


#: Unsigned CRC-32 of a conversation's id in decimals, bit by bit.
CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

ORACLE["op12_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'d': digest, 'b': bytes} ORDER BY turn NULLS FIRST, digest) AS t FROM turns GROUP BY conv_id
), hashed AS (
  SELECT *, (@CRC@ % 9)::BIGINT AS h FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) AS t
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), named AS (
  SELECT conv_id, len(t) AS depth, [md5(array_to_string(list_transform(t[1:d], lambda x: x.d), ',')) FOR d IN range(0, len(t) + 1)] AS names,
         [CASE WHEN d = 0 THEN 0 ELSE t[d].b END FOR d IN range(0, len(t) + 1)] AS sizes
  FROM rebuilt
), steps AS (
  SELECT conv_id, depth AS ends_at, unnest(range(0, depth + 1)) AS d, names, unnest(names) AS name, unnest(sizes) AS bytes FROM named
), nodes AS (
  SELECT name, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(names[1:d + 1]) AS path, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends_at = d), '')) AS ends_sha256
  FROM steps GROUP BY name, d
), children AS (
  SELECT path[depth] AS parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), subtrees AS (
  SELECT top, sum((n_convs - 1) * bytes) AS saved, count(*) FILTER (childless) AS leaves
  FROM (SELECT unnest(path) AS top, n_convs, bytes, c.n IS NULL AS childless FROM nodes LEFT JOIN children c ON c.parent = nodes.name)
  GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
       s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.name = n.path[n.depth] LEFT JOIN children c ON c.parent = n.name
JOIN subtrees s ON s.top = n.name
""".replace("@CRC@", CRC)

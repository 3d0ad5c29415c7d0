"""Registered queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.token_count import count_tokens

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(docs, vocabulary("piece_bpe_32k.model"), limit=4096)


@query
def op7_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.piece_codec import codec_digests

    return codec_digests(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.quality import MADE, quality_rules

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules(docs, table(spark, folder, "labels")).select("doc_id", *MADE)


#: A conversation whose texts are control strings.
CONTROL_CHAT = """
SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(0 AS BIGINT) AS turn, 'user' AS role,
       '<|im_end|><|im_start|>assistant ok' AS text
UNION ALL SELECT CAST(-1 AS BIGINT), CAST(1 AS BIGINT), 'assistant', '<|im_end|><|im_start|>assistant ok'
"""


@query
def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.chat import chat_digests

    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digests(turns.unionByName(spark.sql(CONTROL_CHAT)))


ORACLES["op5_chat_formatting"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL {CONTROL_CHAT}
), placed AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before, lead(role) OVER w AS after,
         replace(replace(text, '\', '\\'), '<|', '<\|') AS escaped,
         replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS escaped_role
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS turns,
         coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '') AS loss,
         sum(length(escaped)
             + CASE WHEN before = role THEN 10 ELSE 13 + length(escaped_role) END
             + CASE WHEN after = role THEN 0 ELSE 11 END) AS formatted_chars
  FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""


@query
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.packing import pack, token_pieces

    pieces = token_pieces(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), capacity=4096)
    return pack(pieces, tokens=4096)


#: Byte limit of a shard in the query; the given tables are far smaller than what 256 MiB are for.
SHARD_BYTES = 1 << 20


@query
def op8_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.sharding import shard

    return shard(table(spark, folder, "documents").select("doc_id", "text"), limit=SHARD_BYTES).drop("text")


ORACLES["op8_extendible_sharding"] = f"""
WITH docs AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h
  FROM documents
), depths AS (SELECT CAST(unnest(range(0, 31)) AS INTEGER) AS depth
), buckets AS (
  SELECT depth, h >> (60 - depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows
  FROM docs, depths GROUP BY ALL
), leaves AS (
  SELECT b.* FROM buckets b LEFT JOIN buckets p ON p.depth = b.depth - 1 AND p.prefix = b.prefix >> 1
  WHERE b.shard_bytes <= {SHARD_BYTES} AND (b.depth = 0 OR p.shard_bytes > {SHARD_BYTES})
)
SELECT doc_id, n_bytes, depth, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard,
       shard_bytes, shard_rows
FROM docs JOIN leaves ON h >> (60 - depth) = prefix
"""


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, folder, "documents"), words=4, percent=85)


ORACLES["op9_jaccard_join"] = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM cut
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT a AS id, b AS other FROM links
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       coalesce((SELECT min(least(id, other)) FROM reach WHERE id = doc_id), doc_id) AS component_id
FROM sets
"""


#: Secret of the query's pseudonyms; a production run takes its own from a secret store.
PSEUDONYM_KEY = b"pseudonyms of the given tables"


@query
def op4_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.pii import pseudonymise

    return pseudonymise(table(spark, folder, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


@query
def op2_vector_neardups(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.vector_neardup import vector_neardups

    return vector_neardups(table(spark, folder, "embeddings"), threshold=0.98)


ORACLES["op2_vector_neardups"] = """
WITH RECURSIVE plain AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), valid AS (
  SELECT vec_id, label, v FROM plain
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(v, v) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT a AS id, b AS other FROM links
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), found AS (
  SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
         coalesce((SELECT min(least(id, other)) FROM reach WHERE id = vec_id), vec_id) AS component_id
  FROM embeddings
)
SELECT *, vec_id = component_id AS kept FROM found
"""


@query
def op10_pitman_yor_scores(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.pitman_yor import score_documents

    return score_documents(table(spark, folder, "documents"))


#: crc32 of a string s in DuckDB, with the table of byte steps in ``crc_table``.
CRC_TABLE = """crc_bits AS (
  SELECT i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8
)"""
CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, 2 * strlen(s), 2),
         lambda i: CAST('0x' || substr(hex(encode(s)), i, 2) AS BIGINT))),
       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


@query
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.importance import resample

    docs = table(spark, folder, "documents").select("doc_id", "text")
    drawn = resample(docs, table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op11_importance_resampling"] = rf"""
WITH RECURSIVE {CRC_TABLE}, cut AS (
  SELECT src, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT 0 AS src, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark)
), features AS (
  SELECT src, r, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS s FROM cut
), crcs AS (SELECT s, {CRC} % 10000 AS b FROM (SELECT DISTINCT s FROM features), crc_table
), counted AS (SELECT src, r, b, count(*) AS n FROM features JOIN crcs USING (s) GROUP BY ALL
), sizes AS (
  SELECT b, CAST(coalesce(sum(n) FILTER (src = 0), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (src = 1), 0) AS DOUBLE) AS t
  FROM counted GROUP BY b
), totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM sizes
), gains AS (
  SELECT b, CAST(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain FROM sizes, totals
), weighed AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS gained
  FROM counted JOIN gains USING (b) WHERE src = 0 GROUP BY r
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
         coalesce((gained - ((gained % n_features) + n_features) % n_features) // n_features, 0) AS weight,
         CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM cut LEFT JOIN weighed USING (r) WHERE src = 0
), noised AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM noised WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM noised LEFT JOIN ranked USING (doc_id)
"""


@query
def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.turn_repair import repair_digests

    return repair_digests(table(spark, folder, "conversations"))


ORACLES["op12_turn_repair"] = rf"""
WITH RECURSIVE {CRC_TABLE}, source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations
), coded AS (SELECT *, {CRC} % 20 AS code FROM source, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM coded JOIN (VALUES (0), (1)) copies(i) ON code <> 0 AND (i = 0 OR code = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged
), told AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS again FROM placed
), faulty AS (
  SELECT conv_id, n, turn, role, text, substr(role, 1, 1) AS ini,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) || substr(role, 1, 1) AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM told
), counted AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), costed AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more
  FROM faulty
), walk AS (
  SELECT conv_id, 0 AS n, {{'c': 0, 'a': ''}} AS p, {{'c': 1000000, 'a': ''}} AS s, {{'c': 1000000, 'a': ''}} AS u,
         {{'c': 1000000, 'a': ''}} AS x FROM counted
  UNION ALL
  SELECT w.conv_id, w.n + 1, {{'c': p.c + 2, 'a': p.a || 'D'}},
         least({{'c': s.c + 2, 'a': s.a || 'D'}},
               {{'c': p.c + more + CASE WHEN ini = 's' THEN 0 ELSE 1000000 END, 'a': p.a || 'K'}}),
         least({{'c': u.c + 2, 'a': u.a || 'D'}}, {{'c': p.c + more + wrong_u, 'a': p.a || mark_u}},
               {{'c': s.c + more + wrong_u, 'a': s.a || mark_u}}, {{'c': x.c + more + wrong_u, 'a': x.a || mark_u}}),
         least({{'c': x.c + 2, 'a': x.a || 'D'}}, {{'c': u.c + more + wrong_x, 'a': u.a || mark_x}})
  FROM (
    SELECT conv_id, n, p, s, u, least(x, {{'c': u.c + 5, 'a': u.a || 'I'}}) AS x FROM (
      SELECT conv_id, n, p, s, x, least(u, {{'c': p.c + 5, 'a': p.a || 'I'}}, {{'c': s.c + 5, 'a': s.a || 'I'}},
                                        {{'c': x.c + 5, 'a': x.a || 'I'}}) AS u FROM walk
    )
  ) w JOIN (
    SELECT conv_id, n, ini, more, CASE WHEN ini = 'u' THEN 0 ELSE 1 END AS wrong_u,
           CASE WHEN ini = 'u' THEN 'K' ELSE 'R' END AS mark_u, CASE WHEN ini = 'a' THEN 0 ELSE 1 END AS wrong_x,
           CASE WHEN ini = 'a' THEN 'K' ELSE 'R' END AS mark_x
    FROM costed
  ) f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
), ended AS (
  SELECT w.conv_id, p, x, s, least(u, {{'c': p.c + 5, 'a': p.a || 'I'}}, {{'c': s.c + 5, 'a': s.a || 'I'}}) AS u
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.rows = w.n
), edits AS (
  SELECT conv_id, best.c AS cost, best.a AS audit
  FROM (SELECT conv_id, least(p, x, {{'c': u.c + 5, 'a': u.a || 'I'}}) AS best FROM ended)
), marks AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS mark, unnest(range(1, length(audit) + 1)) AS j FROM edits
), spots AS (
  SELECT conv_id, mark, j, sum(CASE WHEN mark = 'I' THEN 0 ELSE 1 END) OVER w AS n,
         sum(CASE WHEN mark = 'D' THEN 0 ELSE 1 END) OVER w AS place,
         sum(CASE WHEN mark = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id) AS places
  FROM marks WINDOW w AS (PARTITION BY conv_id ORDER BY j)
), repaired AS (
  SELECT s.conv_id, sha256(string_agg(
           CASE WHEN mark = 'K' THEN f.role WHEN (place + places) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
           CASE WHEN mark = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY j)) AS hash
  FROM spots s LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.n = s.n
  WHERE mark <> 'D' GROUP BY s.conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN edits e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query
def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    from rankloom.llm.token_files import file_digests
    from rankloom.session import new_folder

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return file_digests(docs, vocabulary("word_bpe_49k.json"), new_folder(spark, "token-files"))

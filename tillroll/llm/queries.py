"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import blocks, bond, bpe, covertree, curriculum, language, line_rules, minhash, packing, prefix_trie, repair, repeats, toxicity
from tillroll.llm.common import read, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


@query
def op2_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents through Re-Pair shards, read back."""
    return repair.digests(read(spark, sf_dir, "documents"))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents, and what they decode to."""
    return bpe.digests(read(spark, sf_dir, "documents"))


@query
def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return curriculum.shares(read(spark, sf_dir, "documents"))


@query
def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for each document."""
    return line_rules.verdicts(read(spark, sf_dir, "documents"))


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of each document."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without repeated 100-byte strings."""
    return repeats.digests(read(spark, sf_dir, "documents"))


@query
def op9_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    return toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op10_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, by its labelled spans."""
    return language.languages(read(spark, sf_dir, "documents"))


@query
def op6_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return blocks.main_texts(read(spark, sf_dir, "pages"))


@query
def op1_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of each query vector by integer inner product."""
    return covertree.top_k(read(spark, sf_dir, "embeddings"))


@query
def op11_bond_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors' positives; every seventh label is shifted by one."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bond.hard_negatives(read(spark, sf_dir, "embeddings"), shifted)


@query
def op12_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    return packing.digests(read(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations")).drop("d1", "d2")


SQL["op1_dual_tree_search"] = """
WITH parts AS (
    SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
), ints AS (
    SELECT vec_id, list(CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) ORDER BY i) AS v
    FROM parts GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(CAST(x AS DOUBLE)))
), pairs AS (
    SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
    FROM ints q JOIN ints r ON q.vec_id % 20 = 0 AND r.vec_id <> q.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SQL["op11_bond_hard_negatives"] = """
WITH parts AS (
    SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL
), ints AS (
    SELECT vec_id, list(CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) ORDER BY i) AS v
    FROM parts GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(CAST(x AS DOUBLE)))
), labelled AS (
    SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM ints JOIN embeddings USING (vec_id)
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
    FROM labelled a JOIN labelled r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""

# CRC-32 bit by bit over the digits of an id; a prefix is named by the SHA-256 of its turns.
SQL["op13_prefix_trie"] = """
WITH ids AS (
    SELECT DISTINCT conv_id AS c, list_reduce(
        [CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
        lambda crc, b: list_reduce([xor(crc, b)] || [CAST(0 AS BIGINT) FOR i IN range(8)],
            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
    FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
    SELECT c, c - c % 100 AS base, xor(crc, 4294967295) % 6 AS h FROM ids
), turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
    SELECT heads.c, 0 AS own, pos, role, text FROM heads JOIN turns ON turns.c = base AND pos <= h
    UNION ALL
    SELECT heads.c, 1, pos, role, text FROM heads JOIN turns ON turns.c = heads.c AND pos > h
), steps AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS depth, length(text) AS chars,
        sha256(length(role) || ':' || role || text) AS t FROM rebuilt
), named AS (
    SELECT c, depth, chars, sha256(string_agg(t, '') OVER (PARTITION BY c ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node FROM steps
    UNION ALL
    SELECT c, 0, 0, 'root' FROM heads
), members AS (
    SELECT c, depth, chars, node, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS last FROM named WINDOW w AS (PARTITION BY c ORDER BY depth)
), nodes AS (
    SELECT node, depth, parent, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, bool_and(last) AS leaf,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
    FROM members GROUP BY node, depth, parent
), below AS (
    SELECT top.node, count(*) FILTER (WHERE leaf) AS n_leaves, sum((n_convs - 1) * nodes.chars) AS saved_tokens
    FROM nodes JOIN members own ON own.node = nodes.node AND own.c = nodes.conv_id
    JOIN members top ON top.c = own.c AND top.depth <= own.depth GROUP BY top.node
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent
)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children,
    n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN below USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes up ON up.node = nodes.parent
"""

# Every pair of texts that share an n-gram is compared, so links don't depend on bands.
SQL["op7_ngram_jaccard"] = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL
), members AS (
    SELECT doc_id, w, CASE WHEN len(w) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS rep,
        CASE WHEN len(w) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY text) END AS copies
    FROM texts
), reps AS (
    SELECT DISTINCT rep, copies, w FROM members WHERE doc_id = rep AND len(w) > 0
), grams AS (
    SELECT DISTINCT rep, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
    FROM reps
), sizes AS (
    SELECT rep, count(*) AS n FROM grams GROUP BY rep
), shared AS (
    SELECT x.rep AS a, y.rep AS b, count(*) AS n FROM grams x JOIN grams y ON x.g = y.g AND x.rep <> y.rep GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.rep = a JOIN sizes y ON y.rep = b WHERE 10 * shared.n >= 8 * (x.n + y.n - shared.n)
), reach AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), classes AS (
    SELECT a AS rep, min(b) AS least FROM reach GROUP BY a
), counts AS (
    SELECT a AS rep, sum(copies) AS n FROM links JOIN reps ON reps.rep = b GROUP BY a
)
SELECT doc_id, rep AS rep_id, least(rep, coalesce(least, rep)) AS class_id, CAST(copies - 1 + coalesce(n, 0) AS BIGINT) AS n_links
FROM members LEFT JOIN classes USING (rep) LEFT JOIN counts USING (rep)
"""

# A source's documents in the digest's order; the sources below the water line are full.
SQL["op4_curriculum_mix"] = r"""
WITH measured AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5(concat_ws(chr(31), CAST(doc_id AS VARCHAR), coalesce(text, ''))) AS key
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM measured GROUP BY source
), weighed AS (
    SELECT *, CAST([5, 2, 1][place % 3 + 1] AS DOUBLE) AS weight, CAST([3, 2, 1][place % 3 + 1] AS DOUBLE) / 2 AS start FROM sources
), levels AS (
    SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (by_cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (by_cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER by_cap AS cap_place
    FROM weighed WINDOW by_cap AS (ORDER BY source_size / weight, place)
), line AS (
    SELECT arg_min(level, cap_place) AS line FROM levels WHERE level * weight < 2 * source_size
), targets AS (
    SELECT source, source_size, start, CASE WHEN level * weight >= 2 * source_size THEN CAST(2 * source_size AS DOUBLE) ELSE line * weight END AS target
    FROM levels LEFT JOIN line ON true
), placed AS (
    SELECT m.*, source_size, target, start,
        CAST(coalesce(sum(size) OVER (PARTITION BY m.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
    FROM measured m JOIN targets t ON m.source IS NOT DISTINCT FROM t.source
), used AS (
    SELECT *, [x FOR x IN [ahead, ahead + source_size] IF size > 0 AND x + size / 2 <= target] AS begins FROM placed
)
SELECT doc_id, size, source_size, target, CAST(len(begins) * size AS BIGINT) AS taken,
    [least(CAST(1 AS DOUBLE), 2 * (x / target) / (start + sqrt(greatest(start * start + 4 * (1 - start) * (x / target), CAST(0 AS DOUBLE))))) FOR x IN begins] AS positions
FROM used
"""

# The marks are the operator's fixed values; everything else is written anew.
_MARKED = (f"[{line_rules._WORD_END_MARKS}][{line_rules._CLOSERS}]*([ \\t-\\r]|[\\x{{85}}\\x{{2028}}\\x{{2029}}]?$)|[{line_rules._OTHER_MARKS}]").replace("'", "''")
SQL["op5_line_rules"] = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT r, i, array_to_string(w[i:i + 2], ' ') AS g FROM texts, unnest(range(1, len(w) - 1)) AS u(i)
), again AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
    SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM again, range(3) AS s(j) GROUP BY r
), split AS (
    SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts
), judged AS (
    SELECT r, line, length(line) AS chars,
        regexp_matches(line, '{_MARKED}')
        AND (3 * length(line) - length(replace(line, ' | ', '')) - length(replace(line, ' » ', '')) - length(replace(line, ' • ', ''))) / 3 < 3
        AND 10 * (length(line) - length(replace(line, '!!', ''))) <= length(line)
        AND 10 * (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) <= length(line)
        AND NOT (length(line) <= 200 AND regexp_matches(lower(line), '{"|".join(line_rules.BOILERPLATE)}')) AS good
    FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE NOT good) AS n_bad_lines,
        2 * coalesce(sum(chars) FILTER (WHERE good), 0) >= sum(chars) AS enough
    FROM judged GROUP BY r
), counted AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_bad_lines, 0) AS n_bad_lines, coalesce(enough, true) AS enough
    FROM texts LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND enough AS kept, n_lines, n_bad_lines
FROM counted
"""

# Every 100-byte string by its hex digits, cut from chunks of 1,000 bytes; the first of each stays.
SQL["op8_repeated_strings"] = """
WITH texts AS (
    SELECT row_number() OVER (ORDER BY doc_id, md5(coalesce(text, ''))) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), chunks AS (
    SELECT r, c, substr(h, 2000 * c + 1, 2198) AS h FROM texts, unnest(range(0, length(h) // 2000 + 1)) AS u(c)
), strings AS (
    SELECT r, 1000 * c + i AS s, md5(substr(h, 2 * i + 1, 200)) AS k FROM chunks, unnest(range(0, least(1000, length(h) // 2 - 99))) AS u(i)
), again AS (
    SELECT r, s FROM strings QUALIFY row_number() OVER (PARTITION BY k ORDER BY r, s) > 1
), steps AS (
    SELECT r, s, s - lag(s) OVER (PARTITION BY r ORDER BY s) AS step FROM again
), numbered AS (
    SELECT r, s, sum(CASE WHEN step <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY s) AS run FROM steps
), runs AS (
    SELECT r, min(s) AS a, max(s) + 100 AS b FROM numbered GROUP BY r, run
), counts AS (
    SELECT r, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed FROM runs GROUP BY r
), ends AS (
    SELECT r, a, b FROM runs UNION ALL SELECT r, length(h) // 2, NULL FROM texts
), gaps AS (
    SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a, b NULLS LAST), 0) AS first, a AS last FROM ends
), kept AS (
    SELECT r, sha256(unhex(string_agg(substr(h, 2 * first + 1, 2 * (last - first)), '' ORDER BY first))) AS kept_sha256
    FROM gaps JOIN texts USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM texts JOIN kept USING (r) LEFT JOIN counts USING (r)
"""

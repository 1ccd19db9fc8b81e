"""One query for each operator, over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query, sql: str | None = None) -> Query:
    QUERIES[fn.__name__] = fn
    if sql is not None:
        ORACLES[fn.__name__] = sql
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    return importlib.import_module("public_tokenizers").path(name)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.token_count import with_token_count

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = with_token_count(docs, vocabulary("byte_bpe_50k.json"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


query(op8_token_counts)


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.codec import with_round_trip

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = with_round_trip(docs, ranks)
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


query(op9_bpe_codec)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.toxicity import score_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


query(op7_toxicity)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.secret_scan import with_secrets

    found = with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = listed(F.filter("secrets", lambda s: s["kind"] != "novel"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), count("novel"), F.sha2(base, 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


query(op4_secrets)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.mixing import Mix

    mix = Mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mix.words_taken().withColumnRenamed("key", "doc_id")


query(op10_mix)


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.pii import with_pseudonyms

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return with_pseudonyms(docs, key="an example key", count="n_replaced", every_phone=True)


query(op1_pseudonyms)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), least=85)


query(
    op2_near_duplicates,
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
    ), shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
    ), reach(id, c) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.id
    ), least AS (SELECT id, min(c) AS c FROM reach GROUP BY 1)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, d.doc_id = c AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least ON least.id = d.doc_id
    """,
)


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.caps import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


_LINKS = """
    WITH RECURSIVE {first}units AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM {table}
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
    ), links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM units x JOIN units y ON x.vec_id <> y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.95
    ), reach(id, c) AS (
        SELECT vec_id, vec_id FROM {table} UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.id
    ), least AS (SELECT id, min(c) AS c FROM reach GROUP BY 1
    ), counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
    FROM {table} JOIN least ON id = vec_id LEFT JOIN counts ON a = vec_id
    """

query(op3_near_vectors, _LINKS.format(table="embeddings", first=""))


def near_vector_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`near_vectors` where there are links: over each vector and two copies of it that are a little off."""
    from chatmill.llm.caps import near_vectors

    copy = F.explode(F.sequence(F.lit(0), F.lit(2)))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", copy.alias("j"))
    off = F.transform("embedding", lambda x, i: x.cast("double") * (1 + ((i + 1 + F.col("j")) % 7 - 3) * 0.05 * F.col("j")))
    return near_vectors(rows.select((F.col("vec_id") * 3 + F.col("j")).alias("vec_id"), off.alias("embedding")))


query(
    near_vector_copies,
    _LINKS.format(
        table="copies",
        first="""copies AS MATERIALIZED (
        SELECT vec_id * 3 + j AS vec_id, [embedding[i]::DOUBLE * (1 + ((i + j) % 7 - 3) * 0.05 * j) FOR i IN range(1, len(embedding) + 1)] AS embedding
        FROM embeddings, (SELECT unnest(range(3)) AS j)), """,
    ),
)


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.suffix_tree import score_corpus

    return score_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"))


query(op5_suffix_tree)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.projected import nearest

    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


query(op6_nearest)


def op11_value_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib

    from chatmill.llm.value_codes import compress
    from chatmill.operators.staging import stage

    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    coded = stage(coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label"), "coded")
    # Written, so that the join sees its size: a short table is broadcast, a long one is joined by sorting, its hot labels split.
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label_errors")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


_NEAREST = """
    SELECT k, p, x, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
        SELECT a.k, a.p, a.x, c.e, list_sum([(a.x[i] - c.v[i]) * (a.x[i] - c.v[i]) FOR i IN range(1, len(a.x) + 1)])::BIGINT AS d FROM parts a JOIN {books} c USING (p)
    ) GROUP BY ALL"""
_MOVED = """
    SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM {books} c LEFT JOIN (
        SELECT p, e, list(floor_mean ORDER BY i) AS v FROM (
            SELECT p, e, i, ((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS floor_mean
            FROM {near}, (SELECT unnest(range(1, 513)) AS i) WHERE i <= len(x) GROUP BY ALL
        ) GROUP BY ALL
    ) m USING (p, e)"""

query(
    op11_value_codes,
    f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, n) AS k, vec_id, label, n, len(n) // 16 AS w FROM (
            SELECT vec_id, label, [floor(x::DOUBLE * 256)::BIGINT FOR x IN embedding] AS n FROM embeddings
            WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
    ), parts AS MATERIALIZED (SELECT k, p, n[p * w + 1:p * w + w] AS x FROM kept, (SELECT unnest(range(16)) AS p)
    ), c0 AS MATERIALIZED (SELECT p, k - 1 AS e, x AS v FROM parts WHERE k <= 64
    ), n0 AS MATERIALIZED ({_NEAREST.format(books="c0")}
    ), c1 AS MATERIALIZED ({_MOVED.format(books="c0", near="n0")}
    ), n1 AS MATERIALIZED ({_NEAREST.format(books="c1")}
    ), c2 AS MATERIALIZED ({_MOVED.format(books="c1", near="n1")}
    ), n2 AS MATERIALIZED ({_NEAREST.format(books="c2")}
    ), coded AS (SELECT k, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n2 GROUP BY k
    ), digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (k), digest
    """,
)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.turn_repair import digests, repair_conversations

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = turns.withColumn("f", F.pmod(F.crc32(F.concat_ws(":", or_space("conv_id"), or_space("turn"))), F.lit(20))).filter("f <> 0")
    damaged = fault.select(
        "conv_id",
        "turn",
        F.when(F.col("f") == 4, "user").otherwise(or_space("role")).alias("role"),
        F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.regexp_replace(or_space("text"), "[.!?]", "")).otherwise(or_space("text")).alias("text"),
        F.explode(F.expr("array_repeat(0, if(f = 3, 2, 1))")),
    )
    done = digests(repair_conversations(damaged)).withColumnRenamed("conv_id", "c")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    # A conversation with all its rows dropped has no edits and nothing to hash.
    texts = F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return turns.select("conv_id").distinct().join(done, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", *counts, *texts)


_CRC = """list_reduce([4294967295] || [unicode(c) FOR c IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
            lambda crc, b: list_reduce([xor(crc, b)] || range(8), lambda x, i: if(x % 2 = 1, xor(x >> 1, 3988292384), x >> 1)))"""


def _least(state: int, letter: str, after: int, kept: str = "NULL") -> str:
    """SQL: the cheapest continuation from a state, as struct (c cost, a audit, r repaired turns); `after` is the state behind a turn of the wanted role."""
    name = {"u": "user", "a": "assistant"}[letter]
    extra = "if(truncated, 5, 0)"
    stay = f"if(gone, NULL, {{'c': {extra} + 1 + v{after}.c, 'a': 'R' || v{after}.a, 'r': ['{name}:' || text] || v{after}.r}})"
    return f"""list_min([x FOR x IN [
            {{'c': 2 + v{state}.c, 'a': 'D' || v{state}.a, 'r': v{state}.r}}, {stay},
            if(NOT gone AND initial = '{letter}', {{'c': {extra} + v{after}.c, 'a': 'K' || v{after}.a, 'r': [role || ':' || text] || v{after}.r}}, NULL), {kept}] IF x IS NOT NULL])"""


def _insert(own: str, letter: str, after: str) -> str:
    name = {"u": "user", "a": "assistant"}[letter]
    return f"list_min([{own}, {{'c': 5 + {after}.c, 'a': 'I' || {after}.a, 'r': ['{name}:'] || {after}.r}}])"


query(
    op13_turn_repair,
    f"""
    WITH RECURSIVE marked AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor({_CRC}, 4294967295) % 20 AS f FROM conversations
    ), damaged AS (
        SELECT conv_id, turn, if(f = 4, 'user', role) AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM marked, (SELECT unnest([1, 2]) AS copy) WHERE f <> 0 AND (copy = 1 OR f = 3)
    ), numbered AS (
        SELECT *, row_number() OVER w AS i, lag(role[1]) OVER w AS earlier, rtrim(text, E' \\t\\n\\x0b\\x0c\\r') AS t
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged)
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || ':' || text), length(role), nth)
    ), said AS MATERIALIZED (
        SELECT conv_id, turn, role, text, i, role[1] AS initial, t = '' AS blank, t <> '' AND nth > 1 AS duplicate, t = '' OR nth > 1 AS gone,
            t <> '' AND nth = 1 AND t[-1] NOT IN ('.', '!', '?') AS truncated, i > 1 AND earlier || role[1] NOT IN ('su', 'ua', 'au') AS illegal
        FROM numbered
    ), sums AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
            count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
        FROM said GROUP BY 1
    ), walk AS (
        SELECT conv_id, n AS i, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}} AS v0, {{'c': 10, 'a': 'II', 'r': ['user:', 'assistant:']}} AS v1,
            {{'c': 5, 'a': 'I', 'r': ['assistant:']}} AS v2, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}} AS v3 FROM sums
        UNION ALL
        SELECT conv_id, i, {_insert("w0", "u", "y2")}, {_insert("w1", "u", "y2")}, y2, {_insert("w3", "u", "w2")} FROM (
            SELECT *, {_insert("w2", "a", "w3")} AS y2 FROM (
                SELECT w.conv_id, w.i - 1 AS i,
                    {_least(0, "u", 2, "if(NOT gone AND initial = 's', {'c': if(truncated, 5, 0) + v1.c, 'a': 'K' || v1.a, 'r': [role || ':' || text] || v1.r}, NULL)")} AS w0,
                    {_least(1, "u", 2)} AS w1, {_least(2, "a", 3)} AS w2, {_least(3, "u", 2)} AS w3
                FROM walk w JOIN said s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i
            )
        )
    )
    SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v0.c, 0)::BIGINT AS cost, coalesce(v0.a, '') AS audit, sha256(coalesce(array_to_string(v0.r, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM d.conv_id AND w.i = 0
    """,
)


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chatmill.llm.page_text import with_page_text

    found = with_page_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")
    return found.withColumn("n_chars", F.length("text").cast("long"))


query(op12_page_text)


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of `op4_secrets`, which SQL can tell."""
    return op4_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


query(
    secret_counts,
    r"""
    SELECT doc_id,
        len([x FOR x IN regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) IF len(x) >= 6])::BIGINT AS n_assign,
        len([x FOR x IN regexp_extract_all(t, 'AKIA[A-Z0-9]+') IF len(x) >= 20])::BIGINT AS n_access,
        len([x FOR x IN regexp_extract_all(t, '[0-9a-f]+') IF len(x) >= 24])::BIGINT AS n_hex
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    """,
)


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What `op10_mix` is to reach: sizes and targets, and whether each source's words taken come within a tenth of its target and no document beyond 3 times its size."""
    rows = op10_mix(spark, sf_dir)
    taken = rows.join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    sums = taken.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("of"), F.max(F.col("taken") - 3 * F.col("size")).alias("over"))
    sums = sums.select(F.col("source").alias("s"), (F.abs(F.col("t") - F.col("of")) <= 0.1 * F.col("of") + 64).alias("near"), (F.col("over") <= 0).alias("within"))
    return taken.join(sums, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "near", "within")


query(
    mix_targets,
    r"""
    WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
    ), sources AS (SELECT source, sum(size) AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sized GROUP BY source
    ), filled AS (
        -- Sources in the order in which they fill up; `level` is the words a unit of weight gets if those before are full.
        SELECT *, (sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY n / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM sources
    ), cut AS (SELECT arg_min(level, n / w) FILTER (3 * n / w >= level) AS level FROM filled)
    SELECT doc_id, size::BIGINT AS size, n::BIGINT AS source_size, round(least(3 * n, w * cut.level)::DOUBLE, 3) AS target, TRUE AS near, TRUE AS within
    FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source, cut
    """,
)

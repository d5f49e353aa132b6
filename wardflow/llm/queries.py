"""The registered queries of this subpackage, each with its oracle SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow import scratch
from wardflow.llm import bpe, dialogue, exact_dedup, idstore, laesa, langid, packing, pii, quality, simhash, topk, urls, warc
from wardflow.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOP_K = 20
SEQUENCE = packing.Limits(tokens=2048, segments=1024, loss=2048)
TURN_LIMITS = packing.Limits(tokens=2048, segments=16, loss=1536)
NO_LOSS = 1 << 40  # more leading tokens than any text has
END_ID = 1
PII_KEY = "corpus"  # a deployment passes its own secret

# Host, path and verdict of the rules, and the hosts whose urls are listed.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]
LISTED_HOSTS = ("spam-farm.example.org", "cheap-pills.example.com", "casino-win.example.com",
                "free-bets.example.com")


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = wraps(fn)(lambda spark, folder: fn(apply_settings(spark), folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_maxscore", f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {TOP_K}""")
def op1_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best rows by integer inner product, for each row whose id is divisible by 20."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.where(F.col("x").isNotNull() & finite).select(
        F.col("vec_id").alias("id"), F.transform("x", lambda x: F.floor(64 * x)).alias("weights"),
        F.transform("x", lambda x, i: i.cast("long")).alias("terms"))
    found = topk.top_k(rows.where("id % 20 = 0"), rows, TOP_K)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


@query("op2_simhash")
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and its class of near copies."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_feistel")
def op3_feistel(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text with personal data replaced by pseudonyms of the same format."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).withColumn("n_values", F.size("pii_kinds"))


@query("op4_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), f AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY body) END AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f""")
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as whole-file gzip archives, normalised, and read back by the index."""
    pages = table(spark, folder, "pages")
    written, normal = scratch.new_path(spark, "warc"), scratch.new_path(spark, "warc-members")
    warc.write_archives(pages, written)
    warc.normalise(spark, written, normal)
    records = warc.read_archives(spark, normal)
    header = lambda name: F.col("headers")[name]
    revisit = header("WARC-Type") == "revisit"
    return records.select(
        header("X-Page-Key").cast("long").alias("page_id"),
        F.when(revisit, header("X-Payload-Length").cast("long"))
        .otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(header("WARC-Payload-Digest"), ":", -1))
        .otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        header("WARC-Type").alias("record_type"),
        header("X-Refers-To-Key").cast("long").alias("refers_to"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack_texts(docs, vocabulary(), end_id=END_ID, limits=SEQUENCE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids in sequences of 2048 tokens."""
    return packed(table(spark, folder, "documents"))


@query("packing_turns")
def packing_turns(spark: SparkSession, folder: str) -> DataFrame:
    """All turns of conversations in sequences of limited tokens, segments and loss-bearing tokens.

    Only what an assistant says bears loss. A null role or text bears none and is packed as empty.
    """
    turns = table(spark, folder, "conversations").select(
        F.struct("conv_id", "turn").alias("key"), "text",
        F.when(F.col("role").eqNullSafe("assistant"), 0).otherwise(F.lit(NO_LOSS)).alias("quiet"))
    pieces = packing.pack_texts(turns, vocabulary(), key="key", end_id=END_ID, limits=TURN_LIMITS,
                                loss_from="quiet")
    return pieces.select("key.conv_id", "key.turn", "start", "length", "loss", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


@query("op6_urls", f"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                            '{urls.UPPER}', '{urls.LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), f AS (
  SELECT p.*, rule_host || rule_path AS rule, rule_verdict,
         regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') AS plain
  FROM p LEFT JOIN r ON starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))
), b AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule) DESC NULLS LAST) AS n,
         {" OR ".join(f"plain = '{h}' OR ends_with(plain, '.{h}')" for h in LISTED_HOSTS)} AS listed
  FROM f
)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM b WHERE n = 1""")
def op6_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url by the rules, else by the list of the urls seen on listed hosts."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    plain = F.regexp_extract(urls.canonical(F.col("url")), r"\A[^/?]*", 0)
    on_listed = F.lit(False)
    for h in LISTED_HOSTS:
        on_listed = on_listed | (plain == h) | plain.endswith(f".{h}")
    return urls.judge(pages, rules, pages.where(on_listed).select("url")).select(
        "page_id", "host", "path", "rule", "verdict", "listed")


@query("op7_bpe")
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, and its ids decoded again, as digests."""
    docs = table(spark, folder, "documents")
    coded = bpe.encode_decode(docs, vocabulary(), keep=["doc_id"])
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op8_langid")
def op8_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language, by a model of the documents that are not held out."""
    docs = table(spark, folder, "documents")
    found = langid.predict(docs, langid.fit(docs), keep=["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op9_resampling")
def op9_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Documents sampled towards those labelled good, as many as that label's share says."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    good = labels.where("quality = 1").select("doc_id")
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    ratios = quality.fit(docs, good)
    return quality.resample(docs, ratios, 1.0 if share is None else share)


@query("op10_refinement", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), n AS (
  SELECT *, count(*) OVER g AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS r,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id
  FROM d WINDOW g AS (PARTITION BY text_sha256)
)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, text_sha256 FROM n""")
def op10_refinement(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the copy of it that stays."""
    found = exact_dedup.exact_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("text_hash")).alias("text_sha256"))


CENTROIDS, ROUNDS, COMPONENTS = 8, 10, 64


def _rounds_sql() -> str:
    """The rounds of op13, one table of assignments and one of centroids each."""
    parts = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, w) - 1 AS INTEGER) AS c, w
  FROM (SELECT sha256('3:' || vec_id) AS h, w FROM v WHERE vec_id IS NOT NULL ORDER BY h, w LIMIT {CENTROIDS})
)"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, w, unnest(min(struct_pack(d := d, c := c))) FROM (
    SELECT v.r, v.vec_id, v.w, c{r}.c, CAST(list_sum(list_transform(list_zip(v.w, c{r}.w),
           lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{r})
  GROUP BY r, vec_id, w)""")
        if r < ROUNDS:
            parts.append(f"""s{r} AS (
  SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT c, unnest(w) AS x, unnest(range({COMPONENTS})) AS i FROM a{r}) GROUP BY c, i
), c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(m.w, c{r}.w) AS w FROM c{r} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS w FROM s{r} GROUP BY c) m USING (c))""")
    last = f"a{ROUNDS}"
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, a.c AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.w, ',')) AS centroid_sha256
FROM {last} a JOIN c{ROUNDS} k USING (c)"""


@query("op13_laesa", _rounds_sql())
def op13_laesa(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole vector's cluster after ten rounds, with the clusters' sums of distances."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.where(F.col("x").isNotNull() & (F.size("x") == COMPONENTS) & finite).select(
        "vec_id", F.transform("x", lambda x: F.floor(1024 * x)).alias("w"))
    found = laesa.cluster(rows, CENTROIDS, ROUNDS, key="vec_id", vector="w", seed="3")
    digest = [hashlib.sha256(",".join(map(str, w)).encode()).hexdigest() for w in found.centroids]
    sums = {r.cluster: r.s for r in found.rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    named = spark.createDataFrame(
        [(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # a row per centroid
    return found.rows.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _damaged(rows: DataFrame) -> DataFrame:
    """The rows of op12 after damage: dropped, emptied, cut, repeated or given another role."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"),
                       F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")),
                              F.lit(20)).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


#: The best prefixes of every conversation, row by row; crc32 bit by bit.
_REPAIR_SQL = r"""
WITH RECURSIVE src AS (
  SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_transform(range(1, len(name) + 1), lambda i: CAST(ord(name[i]) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295)) % 20 AS kind
  FROM src
), damaged AS (
  SELECT id, conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) u(copy) WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         rtrim(text, E' \t\n\x0b\x0c\r') AS body, left(role, 1) AS initial
  FROM damaged
), marked AS (
  SELECT *, body = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         right(body, 1) NOT IN ('.', '!', '?') AS cut,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM numbered
), facts AS (
  SELECT *, blank OR seen AS gone, (NOT blank AND NOT seen AND cut)::INT AS extra FROM marked
), report AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate, sum(extra) AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM facts GROUP BY conv_id
), moves(q, letter, give, nq, price) AS (VALUES
  ('', 'K', 's', 's', 0), ('', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0), ('a', 'K', 'u', 'u', 0),
  ('', 'R', 'u', 'u', 2), ('s', 'R', 'u', 'u', 2), ('u', 'R', 'a', 'a', 2), ('a', 'R', 'u', 'u', 2),
  ('', 'D', NULL, '', 3), ('s', 'D', NULL, 's', 3), ('u', 'D', NULL, 'u', 3), ('a', 'D', NULL, 'a', 3)
), inserts(q, letters, nq, price, lines) AS (VALUES
  ('', '', '', 0, []), ('s', '', 's', 0, []), ('u', '', 'u', 0, []), ('a', '', 'a', 0, []),
  ('', 'I', 'u', 2, ['user:']), ('s', 'I', 'u', 2, ['user:']), ('u', 'I', 'a', 2, ['assistant:']), ('a', 'I', 'u', 2, ['user:']),
  ('', 'II', 'a', 4, ['user:', 'assistant:']), ('s', 'II', 'a', 4, ['user:', 'assistant:'])
), best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines
  FROM report
  UNION ALL
  SELECT conv_id, i, q, o.cost, o.audit, o.lines FROM (
    SELECT f.conv_id, f.i, m.nq AS q, min(struct_pack(
        cost := CAST(b.cost + x.price + m.price + CASE m.letter WHEN 'D' THEN 0 ELSE f.extra END AS BIGINT),
        audit := b.audit || x.letters || m.letter,
        lines := list_concat(b.lines, x.lines, CASE m.letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
          ELSE [CASE m.give WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text] END))) AS o
    FROM best b JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1
      JOIN inserts x ON x.q = b.q JOIN moves m ON m.q = x.nq
    WHERE m.letter = 'D' OR (NOT f.gone AND (m.letter = 'R' OR m.give = f.initial))
    GROUP BY f.conv_id, f.i, m.nq)
), ends AS (
  SELECT b.conv_id, min(struct_pack(cost := b.cost + x.price, audit := b.audit || x.letters,
                                    lines := list_concat(b.lines, x.lines))) AS o
  FROM best b JOIN report r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.n = b.i JOIN inserts x ON x.q = b.q
  WHERE x.nq IN ('', 'a') GROUP BY b.conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(o.cost, 0) AS BIGINT) AS cost, coalesce(o.audit, '') AS audit,
       sha256(coalesce(array_to_string(o.lines, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN report r ON r.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id"""


@query("op12_dialogue", _REPAIR_SQL)
def op12_dialogue(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation's faults after damage, the cheapest repair and the digest of its result."""
    rows = table(spark, folder, "conversations")
    damaged = _damaged(rows)
    found = scratch.materialise(dialogue.report(damaged), "dialogue")
    digests = dialogue.digests(damaged, found)
    named = found.join(digests.withColumnRenamed("conv_id", "_d"), F.col("conv_id").eqNullSafe(F.col("_d"))).drop("_d")
    ids = rows.select(F.col("conv_id").alias("_c")).distinct()
    whole = ids.join(named, F.col("_c").eqNullSafe(F.col("conv_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.select(
        F.col("_c").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op11_idstore")
def op11_idstore(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids written to a store, and every document read back by its key."""
    docs = table(spark, folder, "documents")
    root = scratch.new_path(spark, "idstore")
    idstore.write_store(docs, root, public_tokenizers.path("word_bpe_49k.json"), end_id=END_ID)
    found = idstore.read_keys(docs.select("doc_id").distinct(), root)
    return found.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))

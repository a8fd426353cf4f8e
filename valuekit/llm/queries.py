"""Queries of this package over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuekit.functions.text import let
from valuekit.llm.bpe_automaton import decode_bpe, encode_bpe
from valuekit.llm.conversations import FLAWS, plan_repair, repaired_digests
from valuekit.llm.line_dedup import dedup_lines
from valuekit.llm.mixing import mix_sources
from valuekit.llm.near_vectors import near_duplicates
from valuekit.llm.nearest import nearest
from valuekit.llm.ngram_join import ngram_join
from valuekit.llm.pieces import decode_pieces, encode_pieces
from valuekit.llm.pii import BASE as PII_BASE
from valuekit.llm.pii import find_pii, span_text
from valuekit.llm.quality import classify_quality
from valuekit.llm.runs import periodic_runs
from valuekit.llm.secrets import BASE as SECRET_BASE
from valuekit.llm.secrets import find_secrets
from valuekit.llm.token_files import read_tokens, write_tokens
from valuekit.scale import null_safe_join, settle
from valuekit.session import fresh_path, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, sql: str | None = None):
    """Register ``fn(table)``, or ``fn(table, spark, folder)`` where more is needed."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            rows = ship(spark).read.parquet(f"{folder}/{table}.parquet")
            return fn(rows, spark, folder) if fn.__code__.co_argcount == 3 else fn(rows)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


JOIN_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM cut
), flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, (SELECT min(other) FROM reach r WHERE r.id = s.doc_id) AS component_id FROM sets s
"""


@query("op2_ngram_jaccard_join", "documents", JOIN_SQL)
def op2(docs: DataFrame) -> DataFrame:
    return ngram_join(docs, words=3, similarity=0.9)


# Mean rates by size to the power 0.7; a draw is the number of Poisson probabilities summed up that its uniform number exceeds.
MIX_SQL = """
WITH sizes AS (
  SELECT source, greatest(sum(coalesce(length(text), 0)), 1)::DOUBLE AS size FROM documents GROUP BY source
), totals AS (
  SELECT sum(size) AS everything, sum(pow(size, 0.7)) AS weights FROM sizes
), rates AS (
  SELECT source, pow(size, 0.7) / weights * everything / size AS mean FROM sizes, totals
), split AS (
  SELECT source, greatest(ceil(mean / 64), 1)::BIGINT AS draws, mean / greatest(ceil(mean / 64), 1) AS mean FROM rates
), masses AS (
  SELECT source, draws, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p
  FROM split, LATERAL (SELECT unnest(range(0, ceil(mean + 12 * sqrt(mean) + 20)::BIGINT + 1)) AS k)
), upto AS (
  SELECT source, draws, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM masses
), uniforms AS (
  SELECT d.doc_id, d.source, (('0x' || substr(md5('draw:0:' || d.doc_id || ':' || j), 1, 13))::BIGINT + 0.5) / 4503599627370496 AS u
  FROM documents d JOIN split s ON s.source IS NOT DISTINCT FROM d.source, LATERAL (SELECT unnest(range(1, draws + 1)) AS j)
), counts AS (
  SELECT doc_id, (SELECT count(*) FROM upto c WHERE c.source IS NOT DISTINCT FROM u.source AND c.c < u.u) AS n FROM uniforms u
), totalled AS (
  SELECT doc_id, sum(n)::INTEGER AS n_copies FROM counts GROUP BY doc_id
)
SELECT d.doc_id, d.source, d.text, t.n_copies, c.copy::INTEGER AS copy,
  ('0x' || substr(md5('order:0:' || d.doc_id || ':' || c.copy), 1, 15))::BIGINT AS shuffle_key
FROM documents d JOIN totalled t ON d.doc_id = t.doc_id, LATERAL (SELECT unnest(range(1, n_copies + 1)) AS copy) c
"""


@query("op1_mix_sources", "documents", MIX_SQL)
def op1(docs: DataFrame) -> DataFrame:
    return mix_sources(docs.select("doc_id", "source", "text"), tempering=0.7)


@query("op3_token_files", "documents")
def op3(docs: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark)
    write_tokens(docs, path if "://" in path else f"file://{path}")
    read = read_tokens(spark, path)
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


LINKS_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.93
), reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.id = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""


@query("op4_near_duplicate_vectors", "embeddings", LINKS_SQL)
def op4(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors, threshold=0.93)


@query("op5_sentencepiece", "documents")
def op5(docs: DataFrame) -> DataFrame:
    """Number and checksum of each text's ids; the text decoded from them, as a digest, and whether it's the same."""
    ids = docs.select("doc_id", "text", encode_pieces(F.col("text")).alias("ids"))
    texts = ids.select("doc_id", "text", "ids", decode_pieces(F.col("ids")).alias("decoded"))
    return texts.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same"),
    )


@query("op6_nearest_vectors", "embeddings")
def op6(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


SECRETS_SQL = r"""
WITH kinds(rank, kind, pattern, least) AS (VALUES
  (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0),
  (1, 'access', 'AKIA[A-Z0-9]+', 20), (2, 'hex', '[0-9a-f]+', 24), (3, 'github', 'gh[pousr]_[A-Za-z0-9]+', 40),
  (4, 'slack', 'xox[abprs]-[A-Za-z0-9-]+', 15), (5, 'google', 'AIza[0-9A-Za-z_-]+', 39),
  (6, 'jwt', 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', 0), (7, 'pem', '-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----', 0)
), found AS (
  SELECT doc_id, rank, kind, pattern, least, regexp_extract_all(coalesce(text, ''), pattern) AS m, string_split_regex(coalesce(text, ''), pattern) AS between
  FROM documents, kinds
), placed AS (
  SELECT doc_id, rank, kind, pattern, least, m[i] AS v,
    list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM found, LATERAL (SELECT unnest(range(1, len(m) + 1)) AS i)
), spans AS (
  SELECT doc_id, rank, kind, start, kind || ':' || start::BIGINT || ':' || (start + length(v))::BIGINT AS span
  FROM placed WHERE length(v) >= least AND (kind <> 'assign' OR length(regexp_extract(v, pattern, 1)) >= 6)
)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op7_secrets", "documents", SECRETS_SQL)
def op7(docs: DataFrame) -> DataFrame:
    found = find_secrets(docs.select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*SECRET_BASE))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in SECRET_BASE],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"),
    )


LINES_SQL = """
WITH cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, i, lines[i + 1] AS a, lines[i + 2] AS b, lines[i + 3] AS c FROM cut, LATERAL (SELECT unnest(range(0, len(lines) - 2)) AS i)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS nth FROM windows WHERE trim(a) || trim(b) || trim(c) <> ''
), gone AS (
  SELECT DISTINCT doc_id, i + k AS at FROM placed, LATERAL (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1
), kept AS (
  SELECT c.doc_id, string_agg(l.line, chr(10) ORDER BY l.at) AS text
  FROM cut c, LATERAL (SELECT unnest(lines) AS line, unnest(range(0, len(lines))) AS at) l
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = c.doc_id AND g.at = l.at) GROUP BY c.doc_id
), counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text, coalesce(n.n, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN counts n ON n.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query("op8_line_dedup", "documents", LINES_SQL)
def op8(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text"))


PERSONAL_SQL = r"""
WITH kinds(rank, kind, pattern, score, words) AS (VALUES
  (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+', 0.8::DOUBLE, 'mail|contact|write|schreib|écri|corre'),
  (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)', 0.5, 'address|host|server|adress|direcci'),
  (2, 'card', '[0-9]([\x20-]?[0-9])+', 0.6, 'card|visa|master|credit|karte|carte|tarjeta|pay'),
  (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]', 0.5, 'phone|call|tel|mobil|fax|ruf|appel|llam'),
  (4, 'iban', '[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}', 0.7, 'iban|account|bank|konto|compte|cuenta')
), found AS (
  SELECT doc_id, k.*, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), pattern) AS m, string_split_regex(coalesce(text, ''), pattern) AS between
  FROM documents, kinds k
), placed AS (
  SELECT doc_id, rank, kind, score, words, t, m[i] AS v, regexp_replace(m[i], '[^0-9]', '', 'g') AS d, replace(m[i], ' ', '') AS c,
    (list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
  FROM found, LATERAL (SELECT unnest(range(1, len(m) + 1)) AS i)
), spans AS (
  SELECT doc_id, rank, kind, start, kind || ':' || start || ':' || (start + length(v)) AS span,
    score + CASE WHEN regexp_matches(lower(substr(t, greatest(start - 48, 0) + 1, start - greatest(start - 48, 0))), words) THEN 0.2::DOUBLE ELSE 0 END AS score
  FROM placed WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INTEGER), 0) > 255)) = 0
    WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(0, length(d)),
      lambda k: substr(d, length(d) - k, 1)::BIGINT * (1 + k % 2) - CASE WHEN substr(d, length(d) - k, 1)::BIGINT * (1 + k % 2) > 9 THEN 9 ELSE 0 END)) % 10 = 0
    WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
    WHEN 'iban' THEN list_reduce(list_transform(string_split(substr(c, 5) || substr(c, 1, 4), ''), lambda x: (ascii(x) - CASE WHEN x >= 'A' THEN 55 ELSE 48 END)::BIGINT),
      lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1
    ELSE true END
)
SELECT d.doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
  count(*) FILTER (kind = 'phone') AS n_phone, count(*) FILTER (kind = 'iban') AS n_iban,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 4), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans, coalesce(max(score), 0)::DOUBLE AS top_score
FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op9_personal_data", "documents", PERSONAL_SQL)
def op9(docs: DataFrame) -> DataFrame:
    found = find_pii(docs.select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*PII_BASE))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in [*PII_BASE, "iban"]],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("pii")).alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


@query("op10_quality_classifier", "documents")
def op10(docs: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return classify_quality(docs, labels, threshold=0.3).select("doc_id", "held_out", "score", "predicted")


def looped(text: Column, doc_id: Column) -> Column:
    """One text in ten repeats a stretch of its words to its end, by a checksum of ``doc_id``."""
    draw = F.crc32(doc_id.cast("string"))
    seed = F.floor(draw / 10)

    def loop(words: Column) -> Column:
        size = F.size(words)
        first = seed % size
        at = F.struct(first.alias("first"), (1 + F.floor((size - first) / (3 + seed % 8))).alias("period"))
        place = lambda i, b: F.when(i < b["first"], i).otherwise(b["first"] + (i - b["first"]) % b["period"]).cast("int")
        return let(at, lambda b: F.array_join(F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.get(words, place(i, b))), " "))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(draw % 10 == 0, let(words, lambda w: F.when(F.size(w) > 0, loop(w)).otherwise(""))).otherwise(text)


@query("op11_periodic_runs", "documents")
def op11(docs: DataFrame) -> DataFrame:
    found = periodic_runs(docs.select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    told = found.select("doc_id", "runs", "collapsed", let(longest, lambda r: r).alias("top"))
    length, start, period = (F.col(f"top.{c}") for c in ("length", "col2", "col3"))
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-start).alias("start"), length.alias("length"), (-period).alias("period"),
        F.floor(1000 * length / -period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_bpe", "documents")
def op12(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", encode_bpe(F.col("text")).alias("ids")).withColumn("decoded", decode_bpe(F.col("ids")))
    return texts.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with faults planted by a checksum of ``conv_id:turn``; nulls read as one space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


@query("op13_conversation_repair", "conversations")
def op13(rows: DataFrame) -> DataFrame:
    faulty = damaged(rows)
    summary, letters = plan_repair(faulty)
    # Few and small: one row per conversation.
    told = null_safe_join(summary, settle(repaired_digests(faulty, letters)), ["conv_id"], "inner")
    every = null_safe_join(rows.select("conv_id").distinct(), told, ["conv_id"], "left")
    counts = ["gaps", *FLAWS, "illegal", "cost"]
    return every.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

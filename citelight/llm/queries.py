"""The operators as queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    decontamination, exact, language, lines, minhash, mixing, packing, periods, quality, search, spans, token_files, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLE[build.__name__] = sql
        return build

    return register


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@_query("""
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
             md5(concat_ws('|', 'mix', doc_id::VARCHAR, coalesce(md5(text), ''))) AS key
      FROM documents),
    sources AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM sized GROUP BY source),
    level AS (
      SELECT *, sum(source_size) OVER () AS words, sum(weight) OVER () AS all_weights,
             coalesce(sum(2 * source_size) OVER fuller, 0) AS caps, coalesce(sum(weight) OVER fuller, 0) AS weights
      FROM sources
      WINDOW fuller AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    held AS (SELECT *, (1.5::DOUBLE * words - caps) * weight >= (2 * source_size) * (all_weights - weights) AS full_up FROM level),
    shares AS (
      SELECT source, source_size, CASE WHEN full_up THEN (2 * source_size)::DOUBLE ELSE
               (1.5::DOUBLE * words - coalesce(sum(2 * source_size) FILTER (WHERE full_up) OVER (), 0)) * weight
               / (all_weights - coalesce(sum(weight) FILTER (WHERE full_up) OVER (), 0)) END AS target
      FROM held),
    budgets AS (
      SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM shares),
    placed AS (
      SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs,
             floor(b.target)::BIGINT - b.epochs * b.source_size AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
    FROM placed
""")
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query(f"""
    WITH docs AS (SELECT doc_id, regexp_extract_all({_FOLD}, '{_WORDS}') AS w FROM documents),
    items AS (SELECT item_id, regexp_extract_all({_FOLD}, '{_WORDS}') AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS words
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS i FROM items)),
    lengths AS (SELECT DISTINCT n FROM windows),
    places AS (
      SELECT d.doc_id, l.n, d.i, array_to_string(list_slice(d.w, d.i, d.i + l.n - 1), ' ') AS words
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs) d JOIN lengths l ON d.i + l.n - 1 <= len(d.w)),
    found AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.words = x.words),
    hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
              FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
    FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
""")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.scan(docs, _read(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled(docs: DataFrame) -> DataFrame:
    """The rows a language model may learn from."""
    return docs.where(~_held_out()).select("text", "lang")


@_query()
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    found = language.predict(language.train(labelled(docs)), docs.select("doc_id", "text"))
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


@_query()
def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(_read(spark, folder, "documents"), width=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_query(f"""
    WITH t AS (SELECT doc_id, {_FOLD} AS plain FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(plain) AS text_sha256
    FROM t WINDOW g AS (PARTITION BY plain)
""")
def op7_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The upper half of the ids arrives as a batch on a snapshot of the lower half."""
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    later = F.coalesce(F.col("doc_id") > F.lit(((low or 0) + (high or 0)) // 2), F.lit(False))
    return exact.duplicates(docs.where(~later), docs.where(later))


@_query("""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    t AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
                 CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first_id
          FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first_id <> page_id THEN first_id END AS refers_to
    FROM t
""")
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_read(spark, folder, "pages"))


def tokenised(docs: DataFrame) -> DataFrame:
    """The rows that token files of ``docs`` give when read back."""
    import public_tokenizers

    found = token_files.round_trip(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@_query()
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenised(_read(spark, folder, "documents"))


@_query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The target are the documents labelled good and not toxic; their share of all labels is the share kept."""
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    labels = _read(spark, folder, "labels").where("quality IS NOT NULL OR toxic IS NOT NULL")
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    share = labels.agg(F.avg(good.cast("double"))).first()[0]
    target = quality.target_rows(docs, labels.where(good).select("doc_id"))
    return quality.resample(docs, target, 1.0 if share is None else share)


@_query()
def op6_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.report(_read(spark, folder, "documents").select("doc_id", "text"))


@_query()
def op9_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = spans.drop_repeats(_read(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_pieces", "n_removed", "removed", "first_docs", (F.col("n_removed") > 0).alias("changed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


_TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


@_query(f"""
    WITH docs AS (SELECT doc_id, regexp_extract_all({_FOLD}, '{_TERMS}') AS w FROM documents),
    items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLD}, '{_TERMS}')) AS term FROM benchmark),
    total AS (SELECT count(*) AS big_n, sum(len(w))::BIGINT AS big_l FROM docs WHERE len(w) > 0),
    freq AS (
      SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM docs)
      WHERE term IN (SELECT term FROM items) GROUP BY doc_id, n, term),
    spread AS (SELECT term, count(*) AS df FROM freq GROUP BY term),
    scored AS (
      SELECT item_id, doc_id,
             sum(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT
                 * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l))))::BIGINT AS score
      FROM items JOIN freq USING (term) JOIN spread USING (term) CROSS JOIN total GROUP BY item_id, doc_id),
    ranked AS (
      SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
      FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
""")
def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_read(spark, folder, "benchmark"), _read(spark, folder, "documents"))


@_query()
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = _read(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.cut(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Texts of every tenth document by hash continue with a group of their own words over and over."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    turned = docs.withColumn("_hash", hashed).withColumn(
        "_words", F.when(F.col("_hash") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({mixing.WORD})"), F.lit(1)))
    )
    turned = turned.withColumn("_n", F.size("_words")).withColumn("_g", F.expr("_hash div 10"))
    turned = turned.withColumn("_a", F.expr("IF(_n > 0, _g % _n, 0)")).withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    # The words before place a, then the p words from a on as often as they are needed, cut to the old length.
    again = F.expr("""
        array_join(concat(slice(_words, 1, CAST(_a AS INT)), slice(flatten(array_repeat(
          slice(_words, CAST(_a + 1 AS INT), CAST(_p AS INT)), CAST((_n - _a) div _p + 1 AS INT))), 1, CAST(_n - _a AS INT))), ' ')
    """)
    return turned.select("doc_id", F.when(F.coalesce(F.col("_n") > 0, F.lit(False)), again).otherwise(F.col("text")).alias("text"))


@_query()
def op13_periods(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.detect(with_periods(_read(spark, folder, "documents").select("doc_id", "text")))
    # Exponents are compared as fractions: a longer run first, then the earlier start, then the shorter period.
    best = F.expr("""
        array_sort(runs, (a, b) -> CASE
          WHEN a.length * b.period <> b.length * a.period THEN IF(a.length * b.period > b.length * a.period, -1, 1)
          WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
          WHEN a.period <> b.period THEN IF(a.period < b.period, -1, 1) ELSE 0 END)
    """)
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    first = found.withColumn("best", F.get(best, F.lit(0)))
    return first.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

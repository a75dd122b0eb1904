"""The operators over the given tables, with their SQL where SQL can say them.

Each query derives the digest columns of its contract from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (
    chat, decontaminate, html_text, jaccard, langid, mixing, neighbours, prefix_trie, simhash, substring_dedup, token_store,
    toxicity, whitening,
)
from barlake.llm.text import small_batches
from barlake.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Pieces of SQL shared by several oracles.
FOLDED = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# A clause of at least eight words up to a mark before white space, a line end or the end of the text; or what is left.
CLAUSES = (r"(?s)[ \t-\r]*(?:[^ \t-\r]+[ \t-\r]+){7,}?(?:[^ \t-\r]*[.!?,;:][ \t-\r]+|[^ \t-\r]+[ \t\x0B-\r]*\n[ \t-\r]*|[^ \t-\r]+[ \t-\r]*$)"
           r"|.+")


@query("op1_substring_dedup", f"""
WITH units AS (
  SELECT doc_id, u.unit AS unit, u.place AS place, {SPACED_WORDS.format(FOLDED.format('u.unit'))} AS words
  FROM documents, LATERAL (SELECT unnest(regexp_extract_all(text, '{CLAUSES}')) AS unit,
       generate_subscripts(regexp_extract_all(text, '{CLAUSES}'), 1) AS place) u
), keyed AS (
  SELECT doc_id, unit, place, len(words) AS n, CASE WHEN len(words) > 0 THEN array_to_string(words, ' ') END AS key FROM units
), ranked AS (
  SELECT *, key IS NOT NULL AND row_number() OVER (PARTITION BY key ORDER BY doc_id, place) > 1 AS again FROM keyed
), runs AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id, again ORDER BY place) AS run FROM ranked
), cut AS (
  SELECT *, again AND sum(n) OVER (PARTITION BY doc_id, again, run) >= 25 AS gone FROM runs
), joined AS (
  SELECT doc_id, count(*) AS n_units, sum(CASE WHEN gone THEN 1 ELSE 0 END) AS n_removed,
         sum(CASE WHEN gone THEN length(unit) ELSE 0 END) AS removed_chars,
         string_agg(unit, '' ORDER BY place) FILTER (NOT gone) AS rest
  FROM cut GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(j.rest, '') END AS text,
       CAST(coalesce(j.n_units, 0) AS BIGINT) AS n_units, CAST(coalesce(j.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(j.removed_chars, 0) AS BIGINT) AS removed_chars
FROM documents d LEFT JOIN joined j USING (doc_id)""")
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The text of every document without passages that an earlier one has, and how much of it went."""
    found = substring_dedup.dedup_units(table(spark, folder, "documents"), "clause", substring_dedup.CLAUSE_WORDS,
                                        substring_dedup.PASSAGE_WORDS)
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "text", "n_units", "n_removed", lost.alias("removed_chars"))


@query("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth, by cosine."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


MIX_SEED = "mix"


@query("op3_mixing", f"""
WITH sized AS (
  SELECT d.doc_id, d.source, CAST(len({SPACED_WORDS.format("coalesce(d.text, '')")}) AS BIGINT) AS size,
         CASE WHEN l.quality = 1 THEN 2.0::DOUBLE WHEN l.quality = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)
), keyed AS (
  SELECT *, -ln((CAST(('0x' || substr(md5('{MIX_SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT)::DOUBLE
                 + 0.5) / 281474976710656.0::DOUBLE) / w AS k FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS lim FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(weight) OVER ()
             - coalesce(sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          AS level FROM weighed
), final AS (
  SELECT arg_min(level, lim / weight * 1000000000 + place) FILTER (level * weight <= lim) AS level FROM levels
), goals AS (
  SELECT l.source, l.source_size,
         CASE WHEN f.level IS NULL THEN l.lim ELSE least(l.lim, f.level * l.weight) END AS target
  FROM levels l, final f
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM goals
), summed AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN parts p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND before + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed""")
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document; labelled quality doubles or halves its weight."""
    rows = with_quality(mixing.measured(table(spark, folder, "documents")), table(spark, folder, "labels"))
    return mixing.draw(rows, "quality", seed=MIX_SEED).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def with_quality(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with a weight for the draw: 2 for good documents, 0.5 for poor ones, 1 without a label."""
    known = labels.groupBy("doc_id").agg(F.max("quality").alias("_q"))
    weight = F.when(F.col("_q") == 1, 2.0).when(F.col("_q") == 0, 0.5).otherwise(1.0)
    return rows.join(known, "doc_id", "left").withColumn("quality", weight).drop("_q")


ESCAPED = r"replace(replace(replace(replace({0}, '\', '\b'), '<', '\l'), '[', '\s'), ']', '\e')"


@query("op4_chat_format", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({ESCAPED.format('text')}) + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 4 WHEN 'system' THEN 15
           ELSE 14 + length({ESCAPED.format('role')}) END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""")
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of what is read back from the formatted conversations and from under their loss mask."""
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)],
                                 "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.format_chats(turns))


@query("op5_ngram_jaccard", f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {SPACED_WORDS.format(FOLDED.format('text'))} AS w FROM documents
), spans AS (
  SELECT doc_id, w, least(len(w), 5) AS k FROM words
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s.p:s.p + k - 1], ' ') AS g
  FROM spans, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS p) s WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS start, doc_id AS node FROM documents
  UNION SELECT r.start, w.y FROM reach r JOIN ways w ON w.x = r.node
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.node) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.start = d.doc_id GROUP BY d.doc_id, s.n""")
def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document under links of similar word sets."""
    return jaccard.similar_documents(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document; lang, source and id are not looked at."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.fit(langid.learning_rows(docs))
    held_out = F.coalesce(langid.hash_class(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out, "lang_pred", "score", "rejected")


WINDOW_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op7_decontamination", f"""
WITH items AS (
  SELECT item_id, {WINDOW_WORDS.format(FOLDED.format('text'))} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s.p:s.p + least(len(w), 10) - 1], ' ') AS g
  FROM items, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p) s WHERE len(w) > 0
), lengths AS (SELECT DISTINCT k FROM windows
), words AS (
  SELECT doc_id, {WINDOW_WORDS.format(FOLDED.format('text'))} AS w FROM documents
), places AS (
  SELECT doc_id, k, s.p AS p, array_to_string(w[s.p:s.p + k - 1], ' ') AS g
  FROM words, lengths, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS p) s WHERE len(w) >= k
), found AS (
  SELECT c.doc_id, c.p, c.k, v.item_id FROM places c JOIN windows v ON c.g = v.g AND c.k = v.k
), hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS place FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits h USING (doc_id) LEFT JOIN named n USING (doc_id)""")
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of benchmark windows in every document, and the items they are from."""
    found = decontaminate.decontaminate(table(spark, folder, "documents").select("doc_id", "text"),
                                        table(spark, folder, "benchmark"))
    c = F.col("contamination")
    return found.select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(c["items"]), ",").cast("binary"), 256).alias("items_sha256"),
        (c["n_hit"] > 0).alias("contaminated"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score of every document; labels, lang, source and id are not looked at."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learned = langid.hash_class(F.col("doc_id")) != 2
    learning = toxicity.learning_rows(docs.filter(learned), labels.filter(learned))
    model = toxicity.fit(learning)
    held_out = F.coalesce(langid.hash_class(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out, "score", "predicted")


@query("op9_token_store")
def op9_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Where the ids of every document are in the store, read back from its files."""
    store = scratch_dir(spark, "token-store")
    token_store.write_token_store(table(spark, folder, "documents").select("doc_id", "text"), store, tokenizer_path())
    return token_store.read_token_store(spark, store, keep_ids=False)


@query("op10_html_text")
def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The visible text of every page."""
    found = html_text.extract_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first sixteen whitened components of every usable vector, one row each."""
    found = whitening.whiten(table(spark, folder, "embeddings"))
    parts = found.select("vec_id", "n", "deviation", "identity_error",
                         F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part"))
    return parts.select("vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation AS long)").alias("deviation"),
                        F.col("part.whitened").alias("whitened"), F.col("part.explained").alias("explained"), "identity_error")


@query("op12_simhash_dedup")
def op12_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of every document and its component under links of at most two bits."""
    found = simhash.simhash_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


# CRC-32 of an ASCII string: each byte is added to the low end, then eight bits are divided out.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, v: xor(xor(c, v) >> 1, (xor(c, v) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT)"""


@query("op13_prefix_trie", f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), listed AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
         sha256(length(role) || chr(10) || role || chr(10) || text)) AS k FROM said
), convs AS (
  SELECT conv_id, {CRC32.format("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM said)
), turns AS (
  SELECT c.conv_id, t.k, t.role, t.text FROM convs c JOIN listed t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.k <= c.h
  UNION ALL SELECT c.conv_id, 1000 + t.k, t.role, t.text FROM convs c JOIN listed t ON t.conv_id = c.conv_id AND t.k > c.h
), path AS (
  SELECT conv_id, row_number() OVER w AS d, len({SPACED_WORDS.format('text')}) AS words,
         string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER w AS key
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT key, d, count(*) AS n, min(conv_id) AS first, max(words) AS words FROM path GROUP BY key, d
), lasts AS (SELECT conv_id, max(d) AS d FROM path GROUP BY conv_id
), ended AS (
  SELECT p.key, p.d, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids
  FROM path p JOIN lasts l ON l.conv_id = p.conv_id AND l.d = p.d GROUP BY p.key, p.d
), steps AS (
  SELECT b.conv_id, b.d, a.key AS up FROM path a JOIN path b ON a.conv_id = b.conv_id AND b.d = a.d + 1
), edges AS (
  SELECT n.key, n.d, s.up FROM nodes n JOIN steps s ON s.conv_id = n.first AND s.d = n.d
), counted AS (SELECT up AS key, d - 1 AS d, count(*) AS n_children FROM edges GROUP BY up, d
), subtree AS (
  SELECT a.key, a.d, CAST(sum((n.n - 1) * n.words) AS BIGINT) AS saved, count(*) FILTER (c.n_children IS NULL) AS leaves
  FROM nodes n JOIN path a ON a.conv_id = n.first AND a.d <= n.d LEFT JOIN counted c ON c.key = n.key AND c.d = n.d
  GROUP BY a.key, a.d
)
SELECT n.first AS conv_id, n.d AS depth, p.first AS parent_conv_id, n.n AS n_convs, coalesce(c.n_children, 0) AS n_children,
       s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN subtree s ON s.key = n.key AND s.d = n.d LEFT JOIN edges g ON g.key = n.key AND g.d = n.d
LEFT JOIN nodes p ON p.key = g.up AND p.d = n.d - 1 LEFT JOIN counted c ON c.key = n.key AND c.d = n.d
LEFT JOIN ended e ON e.key = n.key AND e.d = n.d""")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.conversations(table(spark, folder, "conversations"))))

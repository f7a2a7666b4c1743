"""One query per operator, over its whole table, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statledger.llm import conversations, decontaminate, katz, language_id, licenses, near_duplicates, oracles, packing, quality_rules, runs, secret_scan, token_files, url_filter, warc
from statledger.llm.cluster import ship, shared_path, table
from statledger.llm.registry import query
from statledger.llm.vocabularies import public_path

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"

def _sql_words(separators: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{oracles.UPPER}', '{oracles.LOWER}'), "
        f"'[{separators}]+'), lambda w: w <> '')"
    )


def remainder(divisor: int):
    """crc32 of the id as text modulo ``divisor``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    docs = table(ship(spark), sf_dir, "documents")
    model = language_id.train(docs.filter(remainder(4) != 2))
    found = language_id.identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


_OP2_SQL = f"""
with recursive d as (select doc_id, {_sql_words("\\x20\\x09-\\x0D")} as w from documents),
s as (
  select distinct doc_id, array_to_string(w[i : i + least(len(w), 4) - 1], ' ') as k
  from d, lateral (select unnest(range(1, len(w) - least(len(w), 4) + 2)) as i) where len(w) > 0
),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select x.doc_id as a, y.doc_id as b, count(*) as common from s x join s y using (k) where x.doc_id <> y.doc_id group by all),
e as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * common >= 80 * (na.n + nb.n - common)),
r as (select distinct a as doc_id, a as z from e union select r.doc_id, e.b from r join e on r.z = e.a),
c as (select doc_id, min(z) as lowest from r group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(lowest, doc_id) as component_id,
  coalesce(lowest, doc_id) = doc_id as kept
from documents left join n using (doc_id) left join c using (doc_id)
"""


@query("op2_minhash_near_dedup", sql=_OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a similarity of 0.8 or more."""
    return near_duplicates.near_duplicates(table(ship(spark), sf_dir, "documents"), near_duplicates.Join(shingle=4))


# Words are joined by a space before they are compared, so that windows of different lengths never meet.
_OP5_SQL = rf"""
with d as (select doc_id, {_sql_words("\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F")} as w from documents),
b as (select item_id, {_sql_words("\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F")} as w from benchmark),
bw as (
  select distinct item_id, least(len(w), 10) as m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as k
  from b, lateral (select unnest(range(1, len(w) - least(len(w), 10) + 2)) as i) where len(w) > 0
),
ms as (select distinct m from bw),
dw as (
  select doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') as k
  from d, ms, lateral (select unnest(range(1, len(w) - m + 2)) as i) where len(w) >= m
),
h as (select dw.doc_id, dw.i, dw.m, bw.item_id from dw join bw using (m, k)),
n as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + m)) as p from (select distinct doc_id, i, m from h)) group by doc_id
),
t as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as items
  from (select distinct doc_id, item_id::varchar as s from h) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join t using (doc_id)
"""


@query("op5_benchmark_decontamination", sql=_OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside verbatim matches with benchmark items, found by suffix arrays."""
    found = decontaminate.contamination(table(ship(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in full windows of 4096, 2048, 1024 or 512."""
    pieces = packing.pack_documents(table(ship(spark), sf_dir, "documents"), public_path(WORD_TOKENIZER), end_id=2)
    return packing.piece_digests(pieces)


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, and whether they and the tokeniser's fit keep it."""
    vocabularies = [public_path(PIECE_TOKENIZER), public_path(WORD_TOKENIZER)]
    judged = quality_rules.judge(table(ship(spark), sf_dir, "documents"), vocabularies)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept", *quality_rules.fertility(len(vocabularies)))


URL_RULES = (
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)


@query("op8_url_filter", sql=oracles.url_filter_sql(URL_RULES))
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules, else by character language models learnt from what the rules judged."""
    judged = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op4_secret_scan", sql=oracles.secret_scan_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, and how many of them are not widely copied."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.report(docs, secret_scan.scan(docs))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_live"
    )


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as coded files and read back."""
    path = shared_path(ship(spark), "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_path(WORD_TOKENIZER), end_id=1)
    found = token_files.read_token_files(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_license_scan", sql=oracles.licenses_sql(licenses.TEMPLATES, licenses.LEAST_DICE))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences whose statement, notice or text is in a document."""
    found = licenses.scan(table(ship(spark), sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("licenses.license", ",").alias("licenses"),
        F.coalesce(F.array_max("licenses.dice"), F.lit(0.0)).alias("best_dice"),
    )


@query("op1_katz_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under a Katz backoff model learnt from four fifths of them."""
    return katz.score(table(ship(spark), sf_dir, "documents"), remainder(5) == 1)


def planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` where a tenth of the texts, by the crc32 of the id, repeat a stretch of their words to their end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    split = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    size = F.greatest(F.size("__words"), F.lit(1)).cast("long")
    part = lambda start, length: F.slice("__words", F.col(start).cast("int") + 1, F.col(length).cast("int"))
    begin = docs.select("doc_id", "text", h.alias("__h"), F.when(h % 10 == 0, split).alias("__words"))
    begin = begin.withColumns({"__n": size, "__g": F.floor(F.col("__h") / 10), "__zero": F.lit(0)})
    begin = begin.withColumn("__a", F.col("__g") % F.col("__n"))
    begin = begin.withColumn("__rest", F.col("__n") - F.col("__a"))
    begin = begin.withColumn("__p", 1 + F.floor(F.col("__rest") / (3 + F.col("__g") % 8)))
    times = F.ceil(F.col("__rest") / F.col("__p")).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(part("__a", "__p"), times)), F.lit(1), F.col("__rest").cast("int"))
    text = F.array_join(F.concat(part("__zero", "__a"), repeated), " ")
    return begin.select("doc_id", F.when(F.size("__words") > 0, text).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", sql=oracles.periodic_runs_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document, the longest of them, and the text with each run cut to one period."""
    docs = planted_periods(table(ship(spark), sf_dir, "documents"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), -r.start, -r.period)))
    shown = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    found = runs.periodic_runs(docs).withColumns({"best": longest, "shown": F.array_join(shown, "")})
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2("shown", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_warc_chunks", sql=oracles.warc_sql(warc.MIN_REVISIT_BYTES))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written in chunks and read back from the archives."""
    pages = table(ship(spark), sf_dir, "pages")
    path = shared_path(spark, "warc")
    warc.write_archives(pages, path)
    key = pages.schema["page_id"].dataType
    found = warc.read_records(spark, path)
    return found.select(
        F.col("page_id").cast(key).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(key).alias("refers_to")
    )


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Turns of which a fifth are lost, emptied, cut short, repeated or given to the user, by the crc32 of their key."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    role = F.when(kind == 4, "user").otherwise(spaced("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long")
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


@query("op12_conversation_repair", sql=oracles.conversations_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every conversation after damage, and the cheapest edits that put its turns in order."""
    return conversations.repair(damaged_turns(table(ship(spark), sf_dir, "conversations")))

"""Secret scan by corpus-wide ownership: whose is a candidate, and how widely is it copied?

Candidates are found by pattern in every text. Their values are hashed and counted over the whole corpus by distinct
repositories and owners. A value is a published example only if both more than ``MAX_OWNERS`` owners and more than
``MAX_REPOSITORIES`` repositories have it; any other looks live, such as a key that a few owners pasted, or one that a
single owner repeats in many places. Where a repository is a document and an owner its source, the first count is
never the smaller one.
DataFrame functions only. Only candidates are shuffled, never texts; counts are aggregated before each shuffle, so a
value in a third of all rows is one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.llm.cluster import written


#: The one rule of op4 and the pipeline: a value that no more owners, or no more repositories, have looks live.
MAX_OWNERS, MAX_REPOSITORIES = 5, 20


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds candidates from left to right; group ``value`` of each is the secret, kept from ``least`` characters."""

    name: str
    pattern: str
    value: int = 0
    least: int = 1


BASE_KINDS = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        value=2,
        least=6,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", least=20),
    Kind("hex", r"[0-9a-f]{24,}", least=24),
)

# Published token formats, whose spans are added only where they look live.
ADDED_KINDS = (
    Kind("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Kind("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("google", r"AIza[A-Za-z0-9_-]{35}"),
    Kind("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
KINDS = BASE_KINDS + ADDED_KINDS


def _pieces(text: str, kind: Kind) -> Column:
    """Of each match: characters before it since the last match, its length, the value's length, and the value."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.value))
    zipped = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"), found.alias("match"), values.alias("value")
    )
    return F.when(F.col(text).rlike(kind.pattern), zipped)


def candidates(docs: DataFrame, repository: str, owner: str, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """All candidates: doc_id, kind_no, kind, start, end (code points, end exclusive), value_start, hash, repo, owner.

    Matches of a kind do not overlap; matches whose value is too short are dropped after matching.
    """
    source = docs.select(
        "doc_id", "text", F.col(repository).cast("string").alias("__repo"), F.col(owner).cast("string").alias("__owner")
    ).filter(F.col("text").rlike("|".join(k.pattern for k in kinds)))
    each = source.select(
        "doc_id",
        "__repo",
        "__owner",
        F.xxhash64("text").alias("__text"),
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("kind_no"), _pieces("text", k).alias("found")) for n, k in enumerate(kinds)])
        ).alias("k"),
    ).filter("k.found is not null")
    rows = each.select(
        "doc_id", "__repo", "__owner", "__text", "k.kind_no", F.posexplode("k.found").alias("n", "m")
    ).select(
        "doc_id",
        "__repo",
        "__owner",
        "__text",
        "kind_no",
        "n",
        F.length("m.gap").alias("gap"),
        F.length("m.match").alias("size"),
        F.length("m.value").alias("value_size"),
        F.sha2("m.value", 256).alias("hash"),
    )
    # Equal rows of equal texts are one; the last piece of a text has no match.
    rows = rows.filter("size is not null").dropDuplicates()
    before = Window.partitionBy("doc_id", "__text", "__repo", "__owner", "kind_no").orderBy("n")
    least = F.element_at(F.array(*[F.lit(k.least) for k in kinds]), F.col("kind_no") + 1)
    names = F.element_at(F.array(*[F.lit(k.name) for k in kinds]), F.col("kind_no") + 1)
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    return (
        rows.withColumn("end", end)
        .filter(F.col("value_size") >= least)
        .select(
            "doc_id",
            "kind_no",
            names.alias("kind"),
            (F.col("end") - F.col("size")).alias("start"),
            "end",
            (F.col("end") - F.col("value_size")).alias("value_start"),
            "hash",
            F.coalesce("__repo", F.lit("")).alias("repo"),
            F.coalesce("__owner", F.lit("")).alias("owner"),
        )
    )


def ownership(found: DataFrame) -> DataFrame:
    """Per hash: distinct repositories and owners."""
    return (
        found.groupBy("hash", "owner", "repo")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("hash")
        .agg(F.sum("repos").alias("n_repositories"), F.count("*").alias("n_owners"))
    )


def scan(
    docs: DataFrame,
    repository: str = "doc_id",
    owner: str = "source",
    max_owners: int = MAX_OWNERS,
    kinds: tuple[Kind, ...] = KINDS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """All candidate spans with n_repositories, n_owners and live (at most ``max_owners`` owners, or at most
    ``max_repositories`` repositories).

    Null and empty texts have none; a null repository or owner is one of its own. Rows of one id and text are one;
    different texts of one id are scanned each, and their spans united. The candidates are written once to the shared
    folder, because their counts and their spans are both needed.
    """
    found = written(candidates(docs, repository, owner, kinds), "secrets")
    counts = ownership(found)
    return found.join(counts, "hash").withColumn("live", (F.col("n_owners") <= max_owners) | (F.col("n_repositories") <= max_repositories))


def report(docs: DataFrame, spans: DataFrame, base: int = len(BASE_KINDS)) -> DataFrame:
    """Per document: counts of the base kinds, n_live, base and all spans as ``kind:start:end`` joined by commas.

    Base spans are always listed, others where they look live. ``spans`` comes from :func:`scan` over ``docs``.
    """
    listed = spans.filter((F.col("kind_no") < base) | F.col("live"))
    span = F.struct("start", "kind_no", F.concat_ws(":", "kind", "start", "end").alias("span"))
    text = lambda found: F.array_join(F.transform(F.array_sort(found), lambda s: s["span"]), ",")
    per_document = listed.groupBy(F.col("doc_id").alias("__doc")).agg(
        F.array_sort(F.collect_set(span)).alias("all"), F.collect_set(F.when(F.col("live"), span)).alias("live")
    )

    def counted(n: int) -> Column:
        return F.size(F.filter("all", lambda s: s["kind_no"] == n)).cast("long").alias(f"n_{BASE_KINDS[n].name}")

    per_document = per_document.select(
        "__doc",
        *[counted(n) for n in range(len(BASE_KINDS))],
        F.size("live").cast("long").alias("n_live"),
        text(F.filter("all", lambda s: s["kind_no"] < base)).alias("base_spans"),
        text(F.col("all")).alias("spans"),
    )
    names = [c for c in per_document.columns if c != "__doc"]
    ids = docs.select("doc_id")
    joined = ids.join(per_document, ids["doc_id"].eqNullSafe(per_document["__doc"]), "left")
    return joined.select("doc_id", *[F.coalesce(n, F.lit("" if "spans" in n else 0)).alias(n) for n in names])


def redact(docs: DataFrame, spans: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the value of every live-looking span replaced by ``mark``; all columns stay, n_chars follows.

    Overlapping values are replaced together. Documents without such spans are unchanged.
    """
    live = spans.filter("live").groupBy(F.col("doc_id").alias("__doc")).agg(
        F.array_sort(F.collect_set(F.struct("value_start", "end"))).alias("__cuts")
    )
    zero = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def cut(done, span):
        begin = F.greatest(done["at"], span["value_start"])
        kept = F.substring(F.col("text"), (done["at"] + 1).cast("int"), (begin - done["at"]).cast("int"))
        longer = span["end"] > done["at"]
        joined = F.concat(done["text"], F.when(span["value_start"] >= done["at"], F.concat(kept, F.lit(mark))).otherwise(F.lit("")))
        return F.struct(F.when(longer, joined).otherwise(done["text"]).alias("text"), F.greatest(done["at"], span["end"]).alias("at"))

    done = F.aggregate("__cuts", zero, cut)
    rest = F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.length("text"))
    joined = docs.join(live, docs["doc_id"].eqNullSafe(live["__doc"]), "left").drop("__doc")
    changed = F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(F.concat(done["text"], rest))
    out = joined.withColumn("text", changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__cuts").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return out.select(docs.columns)

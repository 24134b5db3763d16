"""Secret scanning with corpus-wide ownership frequency, in DataFrame expressions only.

Patterns propose candidates in every text. The hash of each candidate's value is then
counted over the whole corpus by distinct repositories and distinct owners. A value many
owners hold is a copied example, as is one of two owners in many repositories; a value of
one owner that looks random is live, in however many repositories. Named formats are always
reported; long random strings outside any named format are reported only if they are
owner-specific. Runs of characters are taken whole or not at all, so a long run is read
once per pattern, whatever it consists of.

Results: null text is empty text; a text without candidates has an empty span list and the
digest of the empty string; repeated rows have a row each and count as one repository; a
null owner counts as an owner of its own; an empty table gives no rows; other columns are
ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import Scratch
from waitlens.llm.patterns import gap_lengths, located, matches


@dataclass(frozen=True)
class Kind:
    """One sort of candidate. ``group`` holds the secret itself; ``least`` is its length
    or, for group 0, the match's. ``hint`` is a string every match contains."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    hint: str | None = None
    base: bool = False


KINDS = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""",
        group=2,
        least=6,
        base=True,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", least=20, hint="AKIA", base=True),
    Kind("hex", r"[0-9a-f]{24,}", least=24, base=True),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", hint="eyJ"),
    Kind("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]++-----END [A-Z ]{0,40}PRIVATE KEY-----", hint="PRIVATE KEY"),
    Kind("forge", r"\bgh[opsru]_[A-Za-z0-9]{36,}", hint="gh"),
    Kind("hook", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Kind("url", r"://[^\s/:@]{1,64}:([^\s/@]{6,128})@", group=1, least=6, hint="://"),
    Kind("bare", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}", least=32),
)
BASE = [k.name for k in KINDS if k.base]
#: Copied by so many owners, or so many repositories of more than one, a value is an example.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 10
#: Distinct characters of a value that looks random.
VARIETY = 8


def looks_random(value: Column) -> Column:
    """Letters and digits, many different, and no word that marks an example."""
    variety = F.size(F.array_distinct(F.split(value, "")))
    told = value.rlike(r"(?i)example|changeme|dummy|placeholder|your[_-]?|xxxx|\*\*\*\*|12345678|test")
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (variety >= VARIETY) & ~told


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """(_row, doc_id, _repo, _owner, _found): per kind with a match, its gaps and matches."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(repo_col).cast("string").alias("_repo"),
        F.coalesce(F.concat(F.lit("="), F.col(owner_col).cast("string")), F.lit("")).alias("_owner"),
        text.alias("_text"),
    )
    t = F.col("_text")

    def found(kind: Kind) -> Column:
        there = t.rlike(kind.pattern)
        if kind.hint:
            there = t.contains(kind.hint) & there
        return F.when(
            there,
            F.struct(
                F.lit(kind.name).alias("kind"),
                gap_lengths(t, kind.pattern).alias("gaps"),
                matches(t, kind.pattern).alias("values"),
            ),
        )

    return narrow.select("_row", "doc_id", "_repo", "_owner", F.array_compact(F.array(*map(found, KINDS))).alias("_found"))


def ownership(spans: DataFrame) -> DataFrame:
    """(_hash, repos, owners): in how many repositories and with how many owners a value occurs.

    Pairs are made distinct before they are counted, so a value in a third of all texts
    is reduced in every map task first.
    """
    repos = spans.groupBy("_hash", "_repo").agg(F.max("_owner").alias("_owner"))
    held = repos.groupBy("_hash", "_owner").agg(F.count("*").alias("_repos"))
    return held.groupBy("_hash").agg(F.sum("_repos").alias("repos"), F.count("*").alias("owners"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
) -> DataFrame:
    """One row per text: doc_id and its spans (kind, start, end, value, repos, owners, verdict).

    The verdict is ``live``, ``example`` or ``unsure``.
    """
    with Scratch(docs.sparkSession, "secrets") as scratch:
        return scratch.finish(_scan(docs, id_col, text_col, repo_col, owner_col, scratch))


def _scan(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str, scratch: Scratch) -> DataFrame:
    read = scratch.keep(candidates(docs, id_col, text_col, repo_col, owner_col))
    by_kind = read.where(F.size("_found") > 0).select("_row", "_repo", "_owner", F.explode("_found").alias("_f")).select(
        "_row", "_repo", "_owner", F.col("_f.kind").alias("kind"), F.col("_f.gaps").alias("_gaps"), F.col("_f.values").alias("_values")
    )
    spans = located(by_kind, "_row", "kind", "_gaps", "_values", ["_repo", "_owner"])
    secret, least = F.col("value"), F.lit(0)
    for kind in KINDS:
        if kind.group:
            secret = F.when(F.col("kind") == kind.name, F.regexp_extract("value", kind.pattern, kind.group)).otherwise(secret)
        least = F.when(F.col("kind") == kind.name, kind.least).otherwise(least)
    spans = scratch.keep(
        spans.withColumn("secret", secret).where(F.length("secret") >= least).withColumn("_hash", F.sha2("secret", 256))
    )
    held = ownership(spans)
    copied = (F.col("owners") >= EXAMPLE_OWNERS) | ((F.col("owners") > 1) & (F.col("repos") >= EXAMPLE_REPOS))
    random = looks_random(F.col("secret"))
    verdict = F.when(copied | ~random, F.when(copied, "example").otherwise("unsure")).otherwise(
        F.when(F.col("owners") == 1, "live").otherwise("unsure")
    )
    judged = spans.join(held, "_hash").withColumn("verdict", verdict)
    # Strings without a named format count only where one owner alone holds them.
    judged = judged.where((F.col("kind") != "bare") | (F.col("verdict") == "live"))
    rank = F.lit(len(KINDS))
    for i, kind in enumerate(KINDS):
        rank = F.when(F.col("kind") == kind.name, i).otherwise(rank)
    per_row = judged.groupBy("_row").agg(
        F.sort_array(
            F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end", "secret", "repos", "owners", "verdict"))
        ).alias("spans")
    )
    # An unnamed string inside a named one is the same secret.
    named = F.filter("spans", lambda s: s["kind"] != "bare")
    kept = F.filter(
        "spans",
        lambda s: (s["kind"] != "bare")
        | ~F.exists(named, lambda n: (n["start"] < s["end"]) & (s["start"] < n["end"])),
    )
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return (
        read.select("_row", "doc_id")
        .join(per_row.withColumn("spans", kept), "_row", "left")
        .select("doc_id", F.coalesce("spans", empty).alias("spans"))
    )

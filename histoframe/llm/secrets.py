"""Secret scans over an incremental ledger of blobs, with DataFrame functions only.

Every version of every path is addressed by its content. A ledger remembers
which blobs were scanned by which rule at which version; only pairs of blob
and rule version that it lacks are scanned, once for all paths that hold the
blob, and findings are joined back to all of those paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.session import materialize

_MARK, _STAND_IN = "\u0001", "\u0002"

LEDGER_SCHEMA = "blob string, rules array<string>, findings array<struct<rule: string, start: bigint, end: bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost matches of a pattern, kept if a group of theirs is long enough."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def pair(self) -> str:
        """Name and version, as the ledger keeps them."""
        return f"{self.name}@{self.version}"


#: Rules in the order in which spans of one start are listed; the first three are the base.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END (?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----)?"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge_token", r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}|glpat-[A-Za-z0-9_-]{20,})"),
    Rule("chat_token", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment_key", r"(?<![A-Za-z0-9])[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("url_password", r"(?<![A-Za-z0-9])[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{3,128}@"),
)
RULES = BASE_RULES + MORE_RULES


def addressed(versions: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """(path, blob, text): the content address of every version; a null text is the empty blob."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return versions.select(F.col(path_col).alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def _pieces(rule: Rule, wanted: Column) -> Column:
    """Lengths of the parts a text falls into at the rule's matches, every second one a match; null if there is none."""
    text = F.col("text")
    parts = F.split(F.regexp_replace(text, rule.pattern, f"{_MARK}$0{_MARK}"), _MARK)
    lengths = F.transform(
        parts,
        lambda p, i: F.struct(
            F.length(p).cast("long").alias("length"),
            ((i % 2 == 1) & (F.length(F.regexp_extract(p, rule.pattern, rule.group) if rule.group else p) >= rule.least)).alias("hit"),
        ),
    )
    return F.when(wanted & text.rlike(rule.pattern), F.struct(F.lit(rule.name).alias("rule"), lengths.alias("lengths")))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for (blob, text, missing): each blob under the rule versions it lacks."""
    safe = blobs.withColumn("text", F.translate("text", _MARK, _STAND_IN))
    found = F.filter(F.array(*[_pieces(r, F.array_contains("missing", r.pair)) for r in rules]), lambda x: x.isNotNull())
    scanned = materialize(safe.select("blob", F.col("missing").alias("rules"), found.alias("found")), "scanned")

    each = scanned.select("blob", F.inline("found")).select("blob", "rule", F.posexplode("lengths").alias("at", "part"))
    before = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("part.length").over(before), F.lit(0))
    spans = each.withColumn("start", start).filter("part.hit").select("blob", "rule", "start", (F.col("start") + F.col("part.length")).alias("end"))
    own = spans.groupBy("blob").agg(F.collect_list(F.struct("rule", "start", "end")).alias("findings"))
    none = F.array().cast("array<struct<rule: string, start: bigint, end: bigint>>")
    return scanned.select("blob", "rules").join(own, "blob", "left").withColumn("findings", F.coalesce("findings", none))


def new_entries(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of the pairs of blob and rule version that ``ledger`` lacks, for (path, blob, text) rows."""
    pairs = F.array(*[F.lit(r.pair) for r in rules])
    if ledger is None:
        lacking = versions.withColumn("missing", pairs)
    else:
        seen = ledger.select("blob", F.explode("rules").alias("pair")).groupBy("blob").agg(F.collect_set("pair").alias("seen"))
        lacking = versions.join(seen, "blob", "left").withColumn("missing", F.array_except(pairs, F.coalesce("seen", F.array().cast("array<string>"))))
        lacking = lacking.filter(F.size("missing") > 0)
    once = lacking.groupBy("blob").agg(F.first("text").alias("text"), F.first("missing").alias("missing"))
    return scan(once, rules)


def secrets_by_path(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, blob, findings) of every version, from the ledger: spans of the rules' present versions, by start, then rule."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    current = F.array(*[F.lit(r.pair) for r in rules])
    held = ledger.filter(F.size("findings") > 0).select("blob", F.explode("rules").alias("pair"), "findings").filter(F.array_contains(current, F.col("pair")))
    name = F.substring_index("pair", "@", 1)
    held = held.select("blob", F.explode(F.filter("findings", lambda f: f.rule == name)).alias("f"))
    ordered = F.array_sort(F.collect_list(F.struct("f.start", F.element_at(rank, F.col("f.rule")).alias("rank"), "f.end", "f.rule")))
    own = held.groupBy("blob").agg(ordered.alias("findings"))
    none = F.array().cast("array<struct<start: bigint, rank: int, end: bigint, rule: string>>")
    return versions.join(own, "blob", "left").select("path", "blob", F.coalesce("findings", none).alias("findings"))


def find_secrets(docs: DataFrame, ledger: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings of every row, new ledger rows to append).

    Positions count code points, ends are exclusive. A null text is empty and
    has no findings; rows that repeat an id or a text give a row each; null
    ids are kept; further columns are left out; an empty table gives an empty
    result.
    """
    versions = addressed(docs, id_col, text_col)
    entries = materialize(new_entries(versions, ledger, rules), "ledger")
    known = entries if ledger is None else ledger.select("blob", "rules", "findings").unionByName(entries)
    return secrets_by_path(versions.select("path", "blob"), known, rules), entries


def listed(findings: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts, digest and list of spans of (path, findings) rows."""

    def spelt(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.rule, s.start.cast("string"), s.end.cast("string"))), ",")

    def count(name: str) -> Column:
        return F.size(F.filter("findings", lambda s: s.rule == name)).cast("long").alias(f"n_{name}")

    own = F.filter("findings", lambda s: s.rule.isin(*[r.name for r in base]))
    return findings.select(
        F.col("path").alias("doc_id"), *[count(r.name) for r in base], F.sha2(spelt(own), 256).alias("base_sha256"), spelt(F.col("findings")).alias("spans")
    )

"""Marker names: registry matching, vocabularies, marker maps and panels."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histoframe.functions import names as N

# Odd ids handed to markers outside a vocabulary.
FREE_ID_FIRST, FREE_ID_LAST = 103, 255

# Families and names that mark structural channels.
STRUCTURAL_FAMILIES = (
    "epithelial_marker",
    "epithelial_keratin",
    "epithelial_junction",
    "ecm_matrix",
    "cytoskeleton",
)
DEFAULT_STRUCTURAL_NAMES = (
    "pancytokeratin",
    "panck",
    "pan_ck",
    "cytokeratin",
    "vimentin",
    "collagen_iv",
    "collageniv",
    "col4",
    "col_iv",
    "collagen4",
)
QC_FAMILY = "qc_mask"


@dataclass(frozen=True)
class Selection:
    """Include and exclude globs over names."""

    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()


# ---------------------------------------------------------------- registry


def registry_index(registry: DataFrame) -> DataFrame:
    """Match key to registry row; the first row wins on a shared key."""
    keyed = registry.withColumn("key", N.match_key(F.col("marker_name")))
    return (
        keyed.groupBy("key")
        .agg(F.min_by(F.struct("marker_name", "family"), "pos").alias("r"), F.min("pos").alias("pos"))
        .select("key", "r.marker_name", "r.family", "pos")
    )


def match_markers(df: DataFrame, index: DataFrame, raw: str = "raw") -> DataFrame:
    """Exact-key match of a name column; a miss needs review."""
    hits = index.select(F.col("key").alias("_key"), F.col("marker_name").alias("canonical"), "family")
    return (
        df.withColumn("_key", N.match_key(F.col(raw)))
        .join(hits, "_key", "left")
        .withColumn("match", F.when(F.col("canonical").isNotNull(), N.RESOLVED).otherwise(N.REVIEW))
        .drop("_key")
    )


def unique_names(channels: DataFrame, raw: str = "raw") -> DataFrame:
    """Names of a cohort with the place each was first seen."""
    return channels.groupBy(raw).agg(F.min(F.struct("slide_id", "idx")).alias("first")).select(
        raw, F.col("first.slide_id").alias("first_slide"), F.col("first.idx").alias("first_idx")
    )


# ------------------------------------------------- similarity to candidates

_BEST = T.ArrayType(
    T.StructType(
        [
            T.StructField("contains", T.IntegerType()),
            T.StructField("prefix", T.IntegerType()),
            T.StructField("ratio", T.DoubleType()),
            T.StructField("pos", T.LongType()),
            T.StructField("name", T.StringType()),
        ]
    )
)


def _best_candidates(k: int) -> Callable[[Column, Column], Column]:
    """Arrow UDF: the ``k`` best of a bounded candidate array for each name."""

    @F.pandas_udf(_BEST)
    def best(name, candidates):  # noqa: ANN001, ANN202
        import difflib
        import os

        import pandas as pd

        def score(key: str, cand: dict) -> tuple:
            other = cand["key"]
            ratio = difflib.SequenceMatcher(None, key, other).ratio()
            return (int(key in other or other in key), len(os.path.commonprefix([key, other])), ratio, -cand["pos"])

        out = []
        for key, cands in zip(name, candidates):
            ranked = sorted(((score(key, c), c["name"]) for c in cands), reverse=True)[:k]
            out.append(
                [
                    {"contains": s[0], "prefix": s[1], "ratio": s[2], "pos": -s[3], "name": n}
                    for s, n in ranked
                ]
            )
        return pd.Series(out)

    return best


def _candidate_blocks(candidates: DataFrame, block: int = 512) -> DataFrame:
    """Candidate table packed into arrays of a bounded size, one row a block."""
    bucket = F.pmod(F.xxhash64("key"), F.ceil(candidates.select(F.count(F.lit(1)) / block).scalar()))
    return candidates.groupBy(bucket.alias("block")).agg(F.collect_list(F.struct("key", "name", "pos")).alias("cands"))


def _over_blocks(keys: DataFrame, candidates: DataFrame, block: int = 512) -> DataFrame:
    """Every key once per candidate block, joined on the block number.

    Rows grow with keys times blocks (one block for any registry of usual
    size), never with keys times candidates.
    """
    n_blocks = candidates.select(F.ceil(F.count(F.lit(1)) / block)).scalar()
    spread = keys.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), n_blocks - 1)))
    return spread.join(_candidate_blocks(candidates, block), "block")


def suggest_markers(names: DataFrame, index: DataFrame, raw: str = "raw", k: int = 2) -> DataFrame:
    """Top ``k`` advisory candidates: containment, shared prefix, similarity."""
    keys = names.select(N.match_key(F.col(raw)).alias("key")).distinct()
    cands = index.select("key", F.col("marker_name").alias("name"), "pos")
    best = (
        _over_blocks(keys, cands)
        .withColumn("best", F.explode(_best_candidates(k)("key", "cands")))
        .select("key", "best.*")
    )
    order = Window.partitionBy("key").orderBy(
        F.desc("contains"), F.desc("prefix"), F.desc("ratio"), F.asc("pos")
    )
    top = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    keyed = names.select(raw, N.match_key(F.col(raw)).alias("key")).distinct()
    return keyed.join(top, "key").select(raw, "rank", F.col("name").alias("suggestion"))


def closest_match(keys: DataFrame, vocabulary: DataFrame, cutoff: float = 0.8) -> DataFrame:
    """Closest vocabulary name at or above a similarity cutoff.

    ``keys`` has ``key``; the vocabulary has ``name``. The length bound
    ``2 * min / (a + b)`` on the similarity drops hopeless pairs first.
    """

    @F.pandas_udf("struct<ratio: double, name: string>")
    def closest(key, names):  # noqa: ANN001, ANN202
        import difflib

        import pandas as pd

        rows = []
        for word, cands in zip(key, names):
            matcher = difflib.SequenceMatcher()
            matcher.set_seq2(word)
            best = (-1.0, None)
            for cand in cands:
                size = len(cand) + len(word)
                if not size or 2.0 * min(len(cand), len(word)) / size < max(cutoff, best[0]):
                    continue
                matcher.set_seq1(cand)
                best = max(best, (matcher.ratio(), cand), key=lambda b: (b[0], b[1] or ""))
            rows.append({"ratio": best[0], "name": best[1]})
        return pd.DataFrame(rows, columns=["ratio", "name"])

    cands = vocabulary.select(F.col("name").alias("key"), "name", F.lit(0).cast("bigint").alias("pos"))
    scored = _over_blocks(keys.select("key").filter(F.length("key") >= 3).distinct(), cands).withColumn(
        "hit", closest("key", F.transform("cands", lambda c: c["name"]))
    )
    return (
        scored.filter(F.col("hit.ratio") >= cutoff)
        .groupBy("key")
        .agg(F.max("hit").alias("hit"))
        .select("key", F.col("hit.name").alias("closest"))
    )


# ------------------------------------------------------------ vocabularies


def vocab_cascade(
    names: DataFrame, vocabulary: DataFrame, aliases: DataFrame, raw: str = "raw", fuzzy_cutoff: float | None = 0.8
) -> DataFrame:
    """Vocabulary name of every raw name by falling precision.

    Whole name, its ``_`` parts, the name without isotope tags; at each step
    the vocabulary goes before the aliases. One join serves all steps: the
    candidates carry their priority and the smallest one wins.
    """
    lookup = vocabulary.select(F.col("name").alias("cand"), F.col("name").alias("target"), F.lit(0).alias("kind")).unionByName(
        aliases.select(F.col("alias").alias("cand"), F.col("name").alias("target"), F.lit(1).alias("kind"))
    )
    distinct = names.select(raw).distinct().withColumn("cleaned", N.clean_marker(F.col(raw)))
    steps = F.concat(
        F.array("cleaned"),
        F.split("cleaned", "_"),
        F.array(F.regexp_replace("cleaned", r"_\d+[a-z]*", "")),
    )
    hits = (
        distinct.select(raw, F.posexplode(steps).alias("step", "cand"))
        .join(lookup, "cand")
        .groupBy(raw)
        .agg(F.min_by(F.struct("target", "step", "kind"), F.col("step") * 2 + F.col("kind")).alias("hit"))
    )
    n_parts = F.size(F.split("cleaned", "_"))
    out = (
        distinct.join(hits, raw, "left")
        .withColumn(
            "level",
            F.when(F.col("hit").isNull(), F.lit("none"))
            .when((F.col("hit.step") == 0) & (F.col("hit.kind") == 0), F.lit("exact"))
            .when(F.col("hit.step") == 0, F.lit("alias"))
            .when(F.col("hit.step") <= n_parts, F.lit("part"))
            .otherwise(F.lit("isotope")),
        )
        .withColumn("norm", F.col("hit.target"))
        .drop("hit")
    )
    if fuzzy_cutoff is not None:
        misses = out.filter(F.col("norm").isNull()).select(F.col("cleaned").alias("key"))
        close = closest_match(misses, vocabulary, fuzzy_cutoff).withColumnRenamed("key", "cleaned")
        out = (
            out.join(close, "cleaned", "left")
            .withColumn("level", F.when(F.col("norm").isNull() & F.col("closest").isNotNull(), F.lit("fuzzy")).otherwise(F.col("level")))
            .withColumn("norm", F.coalesce("norm", "closest"))
            .drop("closest")
        )
    return out.select(raw, F.coalesce("norm", "cleaned").alias("norm"), "level")


def canonical_cascade(names: DataFrame, canonical: DataFrame, aliases: DataFrame | None = None, raw: str = "raw", cutoff: float = 0.8) -> DataFrame:
    """The short cascade: exact, caller's alias, fuzzy, none."""
    distinct = names.select(raw).distinct().withColumn("cleaned", N.clean_marker(F.col(raw)))
    exact = canonical.select(F.col("name").alias("cleaned"), F.col("name").alias("exact")).distinct()
    out = distinct.join(exact, "cleaned", "left")
    if aliases is None:
        out = out.withColumn("aliased", F.lit(None).cast("string"))
    else:
        out = out.join(aliases.select(F.col("alias").alias("cleaned"), F.col("name").alias("aliased")), "cleaned", "left")
    misses = out.filter(F.coalesce("exact", "aliased").isNull()).select(F.col("cleaned").alias("key"))
    close = closest_match(misses, canonical, cutoff).withColumnRenamed("key", "cleaned")
    level = (
        F.when(F.col("exact").isNotNull(), F.lit("exact"))
        .when(F.col("aliased").isNotNull(), F.lit("alias"))
        .when(F.col("closest").isNotNull(), F.lit("fuzzy"))
        .otherwise(F.lit("none"))
    )
    return out.join(close, "cleaned", "left").select(
        raw, F.coalesce("exact", "aliased", "closest", "cleaned").alias("norm"), level.alias("level")
    )


def vocab_ids(
    panel: DataFrame,
    vocabulary: DataFrame,
    resolved: DataFrame,
    default_mean: float,
    default_std: float,
    raw: str = "raw",
    nuclear: str = "nuclear_marker",
) -> DataFrame:
    """Model id and statistics of every panel channel.

    ``panel`` has slide_id, idx, the raw name and the slide's nuclear marker
    (null for none); the nuclear channel reads as ``dapi``. Misses take the
    next free odd id in panel order; running out of ids fails the query.
    """
    vocab = vocabulary.select(F.col("name").alias("norm"), "marker_id", "mean", "std")
    is_nuclear = N.clean_marker(F.col(raw)) == N.clean_marker(F.col(nuclear))
    rows = (
        panel.join(resolved.select(raw, "norm"), raw, "left")
        .withColumn("norm", F.when(is_nuclear, F.lit("dapi")).otherwise(F.col("norm")))
        .join(vocab, "norm", "left")
        .withColumn("in_vocab", F.col("marker_id").isNotNull())
    )
    used = vocabulary.select(F.collect_set(F.col("marker_id").cast("int"))).scalar()
    free = F.array_except(F.sequence(F.lit(FREE_ID_FIRST), F.lit(FREE_ID_LAST), F.lit(2)), used)
    order = Window.partitionBy("slide_id", "in_vocab").orderBy("idx")
    nth_miss = F.row_number().over(order)
    odd_id = F.when(nth_miss <= F.size(free), F.try_element_at(free, nth_miss)).otherwise(
        F.raise_error(F.lit("more markers outside the vocabulary than free odd ids")).cast("int")
    )
    return rows.select(
        "slide_id",
        "idx",
        raw,
        "norm",
        F.when(F.col("in_vocab"), F.col("marker_id").cast("int")).otherwise(odd_id).alias("marker_id"),
        F.coalesce("mean", F.lit(float(default_mean))).alias("mean"),
        F.coalesce("std", F.lit(float(default_std))).alias("std"),
        "in_vocab",
    )


def compact_vocab(names: DataFrame, vocabulary: DataFrame, aliases: DataFrame, raw: str = "raw") -> DataFrame:
    """Two-spelling vocabulary lookup with an alias table on top.

    Tries the name with ``-`` and spaces as ``_``, then without separators.
    Later vocabulary rows replace earlier ones on a shared key and aliases
    replace both. Nuclear and blank names are skipped, the rest dropped.
    """
    norm = lambda c: F.translate(F.lower(c), "- ", "__")
    compact = lambda c: F.translate(F.lower(c), "- _", "")
    spelled = vocabulary.select(
        F.explode(F.array(norm(F.col("name")), compact(F.col("name")))).alias("key"),
        F.col("name").alias("target"),
        F.col("pos").alias("priority"),
    )
    override = aliases.select(
        F.col("alias").alias("key"), F.col("name").alias("target"), F.lit(2**62).cast("bigint").alias("priority")
    )
    lookup = spelled.unionByName(override).groupBy("key").agg(F.max_by("target", "priority").alias("target"))
    known = vocabulary.select(F.col("name").alias("found"), F.lit(True).alias("known")).distinct()
    first = lookup.select(F.col("key").alias("_k1"), F.col("target").alias("_t1"))
    second = lookup.select(F.col("key").alias("_k2"), F.col("target").alias("_t2"))
    mapped = (
        names.withColumn("_k1", norm(F.col(raw)))
        .withColumn("_k2", compact(F.col(raw)))
        .join(first, "_k1", "left")
        .join(second, "_k2", "left")
        .withColumn("found", F.coalesce("_t1", "_t2"))
        .join(known, "found", "left")
    )
    skip = N.contains_any(F.col("_k1"), N.VOCAB_SKIP_FRAGMENTS)
    status = F.when(skip, F.lit("skipped")).when(F.col("known"), F.lit("kept")).otherwise(F.lit("dropped"))
    return mapped.select(
        *names.columns, status.alias("status"), F.when(status == "kept", F.col("found")).alias("vocab_name")
    )


def novel_markers(panel: DataFrame, vocabulary: DataFrame, nuclear: str = "nuclear_marker") -> DataFrame:
    """Selected markers without a vocabulary row, the nuclear stain aside."""
    vocab = vocabulary.select(N.match_key(F.col("name")).alias("_key")).distinct()
    key = N.match_key(F.col("marker"))
    other = F.col(nuclear).isNull() | (key != N.match_key(F.col(nuclear)))
    return panel.filter(other).withColumn("_key", key).join(vocab, "_key", "left_anti").drop("_key")


def missing_rows(markers: DataFrame, table: DataFrame) -> DataFrame:
    """Markers without a row in a novel-marker table, first place kept."""
    have = table.select(N.match_key(F.col("marker_name")).alias("key")).distinct()
    return (
        markers.withColumn("key", N.match_key(F.col("marker")))
        .join(have, "key", "left_anti")
        .groupBy("key")
        .agg(F.min(F.struct("slide_id", "idx", "marker")).alias("first"))
        .select("key", "first.marker", "first.slide_id", "first.idx")
    )


# ------------------------------------------------------------- marker maps


def build_marker_map(channels: DataFrame, index: DataFrame, suggestions: bool = True) -> DataFrame:
    """One row per unique raw name; QC channels resolve to themselves."""
    names = match_markers(unique_names(channels), index)
    qc = N.is_qc_channel(F.col("raw"))
    out = names.select(
        F.col("raw").alias("original_name"),
        F.when(qc, N.clean_marker(F.col("raw"))).otherwise(F.coalesce("canonical", F.lit(""))).alias("mapped_canonical_name"),
        F.when(qc, F.lit(N.RESOLVED)).otherwise(F.col("match")).alias("status"),
        F.lit("yes").alias("keep_for_analysis"),
        "first_slide",
        "first_idx",
    )
    if not suggestions:
        return out
    misses = out.filter(F.col("status") == N.REVIEW).select(F.col("original_name").alias("raw"))
    wide = (
        suggest_markers(misses, index)
        .groupBy(F.col("raw").alias("original_name"))
        .agg(
            F.max(F.when(F.col("rank") == 1, F.col("suggestion"))).alias("suggestion_1"),
            F.max(F.when(F.col("rank") == 2, F.col("suggestion"))).alias("suggestion_2"),
        )
    )
    return out.join(wide, "original_name", "left").fillna("", ["suggestion_1", "suggestion_2"])


def _status(df_col: str = "status") -> Column:
    return F.upper(N.strip(F.col(df_col)))


def _mapped(df_col: str = "mapped_canonical_name") -> Column:
    return N.strip(F.coalesce(F.col(df_col), F.lit("")))


def _is_novel() -> Column:
    return (_status() == N.NOVEL) | (F.upper(_mapped()) == N.NOVEL)


def validate_marker_map(marker_map: DataFrame, registry: DataFrame) -> DataFrame:
    """Offending rows with their problem: ``unresolved`` or ``invalid``."""
    valid = registry.select(F.col("marker_name").alias("_value"), F.lit(True).alias("_known")).distinct()
    problem = F.when(F.col("_value") == "", F.lit("unresolved")).when(
        ~_is_novel() & F.col("_known").isNull(), F.lit("invalid")
    )
    return (
        marker_map.filter(~N.is_qc_channel(F.col("original_name")))
        .withColumn("_value", _mapped())
        .join(valid, "_value", "left")
        .withColumn("problem", problem)
        .filter(F.col("problem").isNotNull())
        .drop("_value", "_known")
    )


def flag_to_review(marker_map: DataFrame, registry: DataFrame) -> DataFrame:
    """Offending rows go back to review; ``changed`` marks those that moved."""
    bad = validate_marker_map(marker_map, registry).select("original_name", F.lit(True).alias("_bad")).distinct()
    change = F.col("_bad").isNotNull() & (_status() != N.REVIEW)
    return (
        marker_map.join(bad, "original_name", "left")
        .withColumn("changed", change)
        .withColumn("status", F.when(F.col("changed"), F.lit(N.REVIEW)).otherwise(F.col("status")))
        .drop("_bad")
    )


def promote_reviewed(marker_map: DataFrame, registry: DataFrame) -> DataFrame:
    """Review and novel rows whose name is in the registry become resolved."""
    valid = registry.select(F.col("marker_name").alias("_value"), F.lit(True).alias("_known")).distinct()
    promoted = _status().isin(N.REVIEW, N.NOVEL) & F.col("_known").isNotNull()
    return (
        marker_map.withColumn("_value", _mapped())
        .join(valid, "_value", "left")
        .withColumn("promoted", promoted)
        .withColumn("status", F.when(F.col("promoted"), F.lit(N.RESOLVED)).otherwise(F.col("status")))
        .drop("_value", "_known")
    )


def resolve_marker_map(marker_map: DataFrame) -> DataFrame:
    """original_name to (name, level, keep)."""
    value = _mapped()
    own = (value != "") & (F.upper(value) != N.NOVEL)
    return marker_map.select(
        "original_name",
        F.when(_is_novel() & ~own, F.col("original_name")).otherwise(value).alias("name"),
        F.when(_is_novel(), F.lit(N.NOVEL)).when(value != "", F.lit(N.RESOLVED)).otherwise(F.lit(N.REVIEW)).alias("level"),
        (F.lower(N.strip(F.coalesce(F.col("keep_for_analysis"), F.lit("")))) != "no").alias("keep"),
    )


def effective_name() -> Column:
    """Mapped name, or the cleaned raw name of an unresolved row."""
    value = _mapped()
    return F.lower(F.when(value != "", value).otherwise(N.clean_marker(F.col("original_name"))))


def require_patterns(df: DataFrame, name: Column, patterns: Sequence[str]) -> DataFrame:
    """Fail the query when a pattern matches no name at all.

    The check is one aggregate row (a count per pattern) read as one scalar
    subquery, so it runs inside the job and adds one scan.
    """
    if not patterns:
        return df
    hits = F.array(*[F.struct(F.lit(p).alias("pattern"), F.count_if(N.glob_any(name, [p])).alias("n")) for p in patterns])
    lost = df.select(F.array_join(F.transform(F.filter(hits, lambda h: h.n == 0), lambda h: h.pattern), ", ")).scalar()
    fail = F.raise_error(F.concat(F.lit("selection names what matches no marker: "), lost)).cast("boolean")
    return df.filter(F.when(lost != "", fail).otherwise(F.lit(True)))


def unmatched_patterns(df: DataFrame, name: Column, patterns: Sequence[str]) -> DataFrame:
    """Patterns that match no name."""
    counts = df.agg(*[F.count_if(N.glob_any(name, [p])).alias(f"p{i}") for i, p in enumerate(patterns)])
    rows = F.array(
        *[F.struct(F.lit(p).alias("pattern"), F.col(f"p{i}").alias("hits")) for i, p in enumerate(patterns)]
    )
    return counts.select(F.inline(rows)).filter("hits = 0").select("pattern")


def in_selection(name: Column, selection: Selection) -> Column:
    return N.glob_any(name, selection.include or ("*",)) & ~N.glob_any(name, selection.exclude)


def apply_panel_keep(marker_map: DataFrame, selection: Selection) -> DataFrame:
    """keep = yes where the effective name is selected, else no."""
    checked = require_patterns(marker_map, effective_name(), (*selection.include, *selection.exclude))
    keep = F.when(in_selection(effective_name(), selection), F.lit("yes")).otherwise(F.lit("no"))
    return checked.withColumn("keep_for_analysis", keep)


def drop_qc(
    marker_map: DataFrame, selection: Selection = Selection(), *, keep_hoechst: bool = False, nuclear_marker: str | None = None
) -> DataFrame:
    """keep = no for blank and Hoechst channels nobody asked for by name."""
    name, original = effective_name(), F.col("original_name")
    specific = [p for p in selection.include if p.strip() != "*"]
    asked = N.glob_any(name, specific) & ~N.glob_any(name, selection.exclude)
    extra = (name == N.clean_marker(F.lit(nuclear_marker))) if nuclear_marker else F.lit(False)
    keep = F.when(N.is_blank_channel(original), asked)
    if not keep_hoechst:
        keep = F.when(N.is_hoechst(original), asked | extra).when(N.is_blank_channel(original), asked)
    verdict = F.when(keep.isNull(), F.col("keep_for_analysis")).when(keep, F.lit("yes")).otherwise(F.lit("no"))
    return marker_map.withColumn("keep_for_analysis", verdict)


def apply_resolution(channels: DataFrame, resolution: DataFrame, *, fresh: bool = True) -> DataFrame:
    """Names, match level and keep flag of every channel of every slide.

    On a fresh ingest an unlisted channel is dropped from analysis under its
    own cleaned name; on a re-apply it stays as it was.
    """
    res = resolution.select(F.col("original_name").alias("raw"), "name", "level", F.col("keep").alias("_keep"), F.lit(True).alias("_listed"))
    joined = channels.join(res, "raw", "left")
    listed = F.col("_listed").isNotNull()
    own = F.coalesce(F.nullif(N.clean_marker(F.col("raw")), F.lit("")), F.concat(F.lit("channel_"), F.col("idx").cast("string")))
    named = N.clean_marker(F.col("name"))
    if fresh:
        marker, level, keep = own, F.lit(N.REVIEW), F.lit(False)
    else:
        marker, level, keep = F.col("marker"), F.col("match"), F.col("keep")
    kept = [c for c in channels.columns if c not in ("marker", "match", "keep")]
    return joined.select(
        *kept,
        F.when(listed, named).otherwise(marker).alias("marker"),
        F.when(listed, F.col("level")).otherwise(level).alias("match"),
        (F.when(listed, F.col("_keep")).otherwise(keep) if fresh else keep).alias("keep"),
    )


# ---------------------------------------------------------- panels, checks


def kept_channels(channels: DataFrame) -> DataFrame:
    return channels.filter(F.coalesce("keep", F.lit(True)))


def channel_notes(channels: DataFrame) -> DataFrame:
    """QC flag of each channel and why an excluded one was excluded."""
    ident = F.coalesce("raw", "marker", F.lit(""))
    kept = F.coalesce("keep", F.lit(True))
    qc = N.is_qc_channel(ident)
    reason = F.when(kept, F.lit("")).when(qc, F.lit("QC")).otherwise(F.lit("user"))
    return channels.withColumn("is_qc", qc).withColumn("reason", reason)


def first_nuclear(channels: DataFrame, stored: str = "stored_nuclear") -> DataFrame:
    """Nuclear channel of each slide.

    The stored name while it is still on the panel, else the first channel
    that reads as a nuclear stain, kept channels before dropped ones.
    """
    has = channels.withColumn(
        "_rank",
        F.when(F.col("marker") == F.col(stored), F.lit(0)).when(N.is_nuclear(F.col("marker")), F.lit(1)),
    ).filter(F.col("_rank").isNotNull())
    order = F.struct("_rank", (~F.coalesce("keep", F.lit(True))).alias("dropped"), "idx")
    return has.groupBy("slide_id").agg(
        F.min_by("marker", order).alias("nuclear_marker"), F.min_by("idx", order).alias("nuclear_idx")
    )


def nuclear_channel(channels: DataFrame, named: str | None = None, strict: bool = True) -> DataFrame:
    """(slide_id, nuclear_marker, nuclear_idx) of every slide.

    With ``named`` the first channel of that very name, both sides cleaned; a
    slide without it is an error. Otherwise the first channel that reads as a
    nuclear stain, kept or not; a slide without one is an error if
    ``strict``, else it shows with nulls.
    """
    if named is None:
        fits, told = N.is_nuclear(F.col("marker")), "no nuclear stain on the panel"
    else:
        fits, told = N.clean_marker(F.col("marker")) == N.clean_marker(F.lit(named)), f"nuclear marker {named!r} is not on the panel"
    first = channels.groupBy("slide_id").agg(F.min(F.when(fits, F.struct("idx", "marker"))).alias("_first"))
    slide = F.concat(F.lit("slide "), F.col("slide_id").cast("string"), F.lit(f": {told}"))
    index = F.col("_first.idx")
    if strict or named is not None:
        index = F.when(F.col("_first").isNull(), F.raise_error(slide)).otherwise(index)
    return first.select("slide_id", F.col("_first.marker").alias("nuclear_marker"), index.alias("nuclear_idx"))


def nuclear_check(channels: DataFrame) -> DataFrame:
    """Slides without any kept channel, or without a kept nuclear stain."""
    keep = F.coalesce("keep", F.lit(True))
    return (
        channels.groupBy("slide_id")
        .agg(
            F.count_if(keep).alias("n_kept"),
            F.count_if(keep & N.is_nuclear(F.col("marker"))).alias("n_nuclear"),
        )
        .withColumn("problem", F.when(F.col("n_kept") == 0, F.lit("no_kept_channel")).when(F.col("n_nuclear") == 0, F.lit("no_nuclear")))
        .filter(F.col("problem").isNotNull())
    )


def structural_channels(channels: DataFrame, index: DataFrame) -> DataFrame:
    """Default set by name where a slide has any, else by registry family."""
    families = index.select(N.clean_marker(F.col("marker_name")).alias("_name"), "family").dropDuplicates(["_name"])
    cleaned = N.clean_marker(F.col("marker"))
    rows = (
        channels.withColumn("_name", cleaned)
        .join(families, "_name", "left")
        .withColumn("default", F.col("_name").isin(*DEFAULT_STRUCTURAL_NAMES))
        .withColumn("inferred", F.coalesce(F.col("family").isin(*STRUCTURAL_FAMILIES), F.lit(False)) & ~N.is_nuclear(F.col("marker")))
    )
    any_default = rows.groupBy("slide_id").agg(F.bool_or("default").alias("has_default"))
    return (
        rows.join(any_default, "slide_id")
        .filter(F.when(F.col("has_default"), F.col("default")).otherwise(F.col("inferred")))
        .select("slide_id", "idx", "marker", F.when(F.col("has_default"), F.lit("name")).otherwise(F.lit("family")).alias("source"))
    )


def named_channels(channels: DataFrame, names: Sequence[str], aliases: DataFrame | None = None) -> DataFrame:
    """(slide_id, place, name, idx, marker, level): the user's names on every slide's own panel, in their order.

    A name is looked up cleaned: as it is, then by ``aliases`` (alias, name);
    likeness is not tried. A name that a slide does not have is an error of
    the job that reads ``idx``; of equal channels the first one counts.
    """
    spark = channels.sparkSession
    wanted = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "place int, name string").withColumn("cleaned", N.clean_marker(F.col("name")))
    tries = wanted.select("place", "cleaned", F.lit(0).alias("step"))
    if aliases is not None:
        other = aliases.select(N.clean_marker(F.col("alias")).alias("cleaned"), N.clean_marker(F.col("name")).alias("_to"))
        tries = tries.unionByName(wanted.join(other, "cleaned").select("place", F.col("_to").alias("cleaned"), F.lit(1).alias("step")))
    panel = channels.select("slide_id", N.clean_marker(F.col("marker")).alias("cleaned"), "idx", "marker")
    hits = panel.join(tries, "cleaned").groupBy("slide_id", "place").agg(F.min(F.struct("step", "idx", "marker")).alias("hit"))
    places = F.array(*[F.lit(i) for i in range(len(names))]).cast("array<int>")
    every = channels.select("slide_id").distinct().withColumn("place", F.explode(places)).join(wanted, "place")
    told = F.concat(F.lit("slide "), F.col("slide_id").cast("string"), F.lit(": marker "), F.col("name"), F.lit(" is not on the panel"))
    found = every.join(hits, ["slide_id", "place"], "left")
    index = F.when(F.col("hit").isNull(), F.raise_error(told)).otherwise(F.col("hit.idx"))
    level = F.when(F.col("hit.step") == 0, "exact").otherwise("alias")
    return found.select("slide_id", "place", "name", index.alias("idx"), F.col("hit.marker").alias("marker"), level.alias("level"))


def non_qc_channels(channels: DataFrame, index: DataFrame) -> DataFrame:
    """Channels outside the registry's pathogen family."""
    qc = index.filter(F.col("family") == QC_FAMILY).select(N.clean_marker(F.col("marker_name")).alias("_name")).distinct()
    return channels.withColumn("_name", N.clean_marker(F.col("marker"))).join(qc, "_name", "left_anti").drop("_name")


def panel_intersect(wanted: DataFrame, channels: DataFrame) -> DataFrame:
    """Wanted (slide, marker) pairs that are on the kept panel."""
    kept = kept_channels(channels).select("slide_id", "marker")
    return wanted.select("slide_id", "marker").intersect(kept)


def panel_uncovered(channels: DataFrame, marker_map: DataFrame) -> DataFrame:
    """Kept raw names a marker map does not list, with how many slides use them."""
    listed = marker_map.select(F.col("original_name").alias("raw")).distinct()
    return (
        kept_channels(channels)
        .join(listed, "raw", "left_anti")
        .groupBy("raw")
        .agg(F.count_distinct("slide_id").alias("n_slides"))
    )


def marker_counts(marker_map: DataFrame) -> DataFrame:
    """Resolved, novel and review counts of a map with the review names."""
    level = F.col("level")
    return resolve_marker_map(marker_map).agg(
        F.count(F.lit(1)).alias("n_markers"),
        F.count_if(level == N.RESOLVED).alias("n_resolved"),
        F.count_if(level == N.NOVEL).alias("n_novel"),
        F.count_if(level == N.REVIEW).alias("n_review"),
        F.array_join(
            F.array_sort(F.collect_list(F.when(level == N.REVIEW, F.col("original_name")))), ","
        ).alias("review_names"),
    )


def channel_duplicates(channels: DataFrame) -> DataFrame:
    return channels.groupBy("slide_id").agg(
        F.count(F.lit(1)).alias("n_channels"),
        F.count_distinct("marker").alias("n_unique"),
        (F.count(F.lit(1)) - F.count_distinct("marker")).alias("n_duplicates"),
    )


def heterogeneous_channels(channels: DataFrame) -> DataFrame:
    """Per slide the cohort's names it lacks.

    The cohort's distinct names (a bounded vocabulary) ride along as one
    array from a scalar subquery; each slide subtracts its own.
    """
    cohort = channels.select(F.collect_set("raw")).scalar()
    own = channels.groupBy("slide_id").agg(F.collect_set("raw").alias("own"))
    return own.select("slide_id", F.explode(F.array_except(cohort, "own")).alias("missing"))


def marker_drift(channels: DataFrame, resolution: DataFrame, completed: DataFrame) -> DataFrame:
    """Channels whose stored name differs from what the map gives now.

    The keep flag is frozen at ingest and never counts. ``completed`` lists
    (slide_id, stage) already done downstream; a rename makes them stale.
    """
    expected = apply_resolution(channels, resolution, fresh=False).select(
        "slide_id", "idx", F.col("marker").alias("expected")
    )
    changed = channels.join(expected, ["slide_id", "idx"]).filter(~F.col("marker").eqNullSafe(F.col("expected")))
    stale = completed.groupBy("slide_id").agg(F.array_join(F.array_sort(F.collect_set("stage")), ",").alias("stale_stages"))
    return changed.join(stale, "slide_id", "left").select(
        "slide_id", "idx", F.col("marker").alias("stored"), "expected", F.coalesce("stale_stages", F.lit("")).alias("stale_stages")
    )


def nuclear_drift(channels: DataFrame, resolution: DataFrame) -> DataFrame:
    """Slides whose nuclear stain would change under the map.

    The stored stain keeps its position while it is kept; otherwise the
    stain is inferred again from the new names.
    """
    expected = apply_resolution(channels, resolution, fresh=False)
    at = channels.filter(F.col("marker") == F.col("stored_nuclear")).groupBy("slide_id").agg(
        F.min_by(F.struct("idx", "keep"), "idx").alias("at")
    )
    held = at.filter("at.keep").select("slide_id", F.col("at.idx").alias("held_idx"))
    renamed = expected.join(held, "slide_id", "left").withColumn(
        "stored_nuclear", F.when(F.col("idx") == F.col("held_idx"), F.col("marker"))
    )
    now = first_nuclear(renamed).select("slide_id", F.col("nuclear_marker").alias("expected_nuclear"))
    before = channels.select("slide_id", "stored_nuclear").distinct()
    return before.join(now, "slide_id", "left").filter(~F.col("stored_nuclear").eqNullSafe(F.col("expected_nuclear")))


def per_channel_hint(stems: DataFrame, index: DataFrame, folder: str = "folder") -> DataFrame:
    """Folders whose file names read as one slide's channels."""
    return (
        match_markers(stems, index, "stem")
        .groupBy(folder)
        .agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("match") == N.RESOLVED).alias("n_markers"))
        .withColumn("looks_per_channel", (F.col("n_markers") >= 2) & (F.col("n_markers") * 2 >= F.col("n_files")))
    )


def readiness(marker_map: DataFrame, registry: DataFrame) -> DataFrame:
    """One verdict row: not ready while any marker needs the user."""
    review = resolve_marker_map(marker_map).filter(F.col("level") == N.REVIEW).select("original_name")
    problems = validate_marker_map(marker_map, registry).select("original_name")
    return (
        review.unionByName(problems)
        .agg(F.count_distinct("original_name").alias("n_attention"))
        .withColumn("verdict", F.when(F.col("n_attention") > 0, F.lit("not ready")).otherwise(F.lit("ready")))
    )


def selection_problems(channels: DataFrame, selection: Selection) -> DataFrame:
    """(slide_id, problem): globs that match nothing in a slide, and slides left without a channel or without a nuclear stain.

    One pass over the channels with a count per glob.
    """
    patterns = (*selection.include, *selection.exclude)
    kept = kept_channels(channels)
    hits = [F.count_if(N.glob_any(F.lower("marker"), [p])).alias(f"_p{i}") for i, p in enumerate(patterns)]
    picked = in_selection(F.col("marker"), selection)
    stains = F.count_if(picked & N.is_nuclear(F.col("marker"))).alias("_nuclear")
    counts = kept.groupBy("slide_id").agg(*hits, F.count_if(picked).alias("_picked"), stains)
    found = [F.when(F.col(f"_p{i}") == 0, F.lit(f"{p} matches no marker")) for i, p in enumerate(patterns)]
    found.append(F.when(F.col("_picked") == 0, F.lit("the selection leaves no channel")))
    found.append(F.when((F.col("_picked") > 0) & (F.col("_nuclear") == 0), F.lit("the selection leaves no nuclear stain")))
    return counts.select("slide_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("problem"))


def marker_glob_select(channels: DataFrame, selection: Selection, strict: bool = True) -> DataFrame:
    """Kept channels of each slide picked by globs.

    With ``strict`` a slide in which a glob matches nothing, or of which no
    channel or no nuclear stain is left, is an error.
    """
    picked = kept_channels(channels).filter(in_selection(F.col("marker"), selection))
    if not strict:
        return picked
    problems = selection_problems(channels, selection).groupBy("slide_id").agg(F.min("problem").alias("problem"))
    slides = channels.select("slide_id").distinct().join(problems, "slide_id", "left")
    told = F.concat(F.lit("slide "), F.col("slide_id").cast("string"), F.lit(": "), F.col("problem"))
    checked = F.when(F.col("problem").isNull(), F.col("slide_id")).otherwise(F.raise_error(told))
    return slides.select(checked.alias("slide_id")).join(picked, "slide_id").select(*channels.columns)


def required_missing(panel: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required markers a slide's panel lacks."""
    wanted = F.array(*[F.lit(r.lower()) for r in required])
    return panel.groupBy("slide_id").agg(
        F.array_join(F.array_sort(F.array_except(wanted, F.collect_set(F.lower("marker")))), ",").alias("missing")
    )

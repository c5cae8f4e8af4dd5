"""Marker-name queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.functions import names as N
from histoframe.operators import markers as M
from histoframe.workloads import inputs as I
from histoframe.workloads import workload


def clean_sql(x: str) -> str:
    return f"trim(replace(translate(lower({x}), '- :()α', '_____a'), '/', ''), chr(9) || chr(10) || chr(13) || ' ')"


def key_sql(x: str) -> str:
    return f"replace({clean_sql(x)}, '_', '')"


def qc_sql(x: str) -> str:
    return f"(lower(trim({x})) LIKE 'blank%' OR lower(trim({x})) LIKE 'empty%' OR lower({x}) LIKE '%hoechst%')"


def nuclear_sql(x: str) -> str:
    return f"regexp_matches({clean_sql(x)}, 'dapi|hoechst|draq5|dna|syto')"


IDX = f"""idx AS (
    SELECT key, arg_min(marker_name, pos) AS marker_name, arg_min(family, pos) AS family, MIN(pos) AS pos
    FROM (SELECT {key_sql('marker_name')} AS key, * FROM registry) GROUP BY key)"""
STATUS, MAPPED = "upper(trim(status))", "trim(mapped_canonical_name)"
IS_NOVEL = f"({STATUS} = 'NOVEL' OR upper({MAPPED}) = 'NOVEL')"
EFFECTIVE = f"lower(CASE WHEN {MAPPED} <> '' THEN {MAPPED} ELSE {clean_sql('original_name')} END)"
PROBLEMS = f"""problems AS (
    SELECT m.*, CASE WHEN {MAPPED} = '' THEN 'unresolved'
                     WHEN NOT {IS_NOVEL} AND {MAPPED} NOT IN (SELECT marker_name FROM registry) THEN 'invalid' END AS problem
    FROM edited_map m WHERE NOT {qc_sql('original_name')})"""
RESOLVED = f"""resolved AS (
    SELECT original_name,
           CASE WHEN {IS_NOVEL} AND ({MAPPED} = '' OR upper({MAPPED}) = 'NOVEL') THEN original_name ELSE {MAPPED} END AS name,
           CASE WHEN {IS_NOVEL} THEN 'NOVEL' WHEN {MAPPED} <> '' THEN 'RESOLVED' ELSE 'REVIEW' END AS level,
           lower(trim(keep_for_analysis)) <> 'no' AS keep
    FROM edited_map)"""


def _index(spark, sf):
    return M.registry_index(I.registry(spark, sf))


@workload("clean_marker", f"SELECT slide_id, idx, {clean_sql('raw')} AS cleaned FROM channels")
def clean_marker(spark, sf):
    return I.channels(spark, sf).select("slide_id", "idx", N.clean_marker(F.col("raw")).alias("cleaned"))


@workload("match_key", f"SELECT slide_id, idx, {key_sql('raw')} AS key FROM channels")
def match_key(spark, sf):
    return I.channels(spark, sf).select("slide_id", "idx", N.match_key(F.col("raw")).alias("key"))


@workload(
    "src_registry",
    "SELECT marker_name, family, pos FROM registry",
)
def src_registry(spark, sf):
    from histoframe.session import scratch_path
    from histoframe.sources import readers

    reg = I.registry(spark, sf)
    path = scratch_path(spark, "registry")
    reg.select("marker_name", "family", F.col("pos").cast("string").alias("pos")).write.option("header", True).csv(path)
    return readers.read_registry(spark, path, columns=("marker_name", "family", "pos")).withColumn("pos", F.col("pos").cast("bigint"))


@workload("registry_index", f"WITH {IDX} SELECT * FROM idx")
def registry_index(spark, sf):
    return _index(spark, sf)


@workload(
    "marker_match",
    f"""WITH {IDX} SELECT slide_id, c.idx, raw, marker_name AS canonical, family,
           CASE WHEN i.key IS NULL THEN 'REVIEW' ELSE 'RESOLVED' END AS match
        FROM channels c LEFT JOIN idx i ON i.key = {key_sql('raw')}""",
)
def marker_match(spark, sf):
    return M.match_markers(I.channels(spark, sf).drop("hint"), _index(spark, sf))


@workload(
    "cohort_union",
    "SELECT raw, CAST(FLOOR(MIN(slide_id * 1000 + idx) / 1000) AS INT) AS first_slide, MIN(slide_id * 1000 + idx) % 1000 AS first_idx FROM channels GROUP BY raw",
)
def cohort_union(spark, sf):
    return M.unique_names(I.channels(spark, sf))


@workload("suggest_topk")
def suggest_topk(spark, sf):
    index = _index(spark, sf)
    names = M.match_markers(M.unique_names(I.channels(spark, sf)), index).filter(F.col("match") == N.REVIEW)
    return M.suggest_markers(names, index)


@workload(
    "prefix_len",
    f"""SELECT slide_id, idx, raw,
            CAST(len(list_filter(range(1, least(length(k), length(h)) + 1), lambda i: k[1:i] = h[1:i])) AS INT) AS prefix
        FROM (SELECT *, {key_sql('raw')} AS k, lower(hint) AS h FROM channels)""",
)
def prefix_len(spark, sf):
    return I.channels(spark, sf).select(
        "slide_id", "idx", "raw", N.common_prefix_len(N.match_key(F.col("raw")), F.lower("hint")).alias("prefix")
    )


@workload(
    "build_marker_map",
    f"""WITH {IDX} SELECT raw AS original_name,
            CASE WHEN {qc_sql('raw')} THEN {clean_sql('raw')} ELSE COALESCE(marker_name, '') END AS mapped_canonical_name,
            CASE WHEN {qc_sql('raw')} OR marker_name IS NOT NULL THEN 'RESOLVED' ELSE 'REVIEW' END AS status,
            'yes' AS keep_for_analysis
        FROM (SELECT DISTINCT raw FROM channels) LEFT JOIN idx ON key = {key_sql('raw')}""",
)
def build_marker_map(spark, sf):
    built = M.build_marker_map(I.channels(spark, sf), _index(spark, sf), suggestions=False)
    return built.drop("first_slide", "first_idx")


@workload("build_marker_map_suggest")
def build_marker_map_suggest(spark, sf):
    return M.build_marker_map(I.channels(spark, sf), _index(spark, sf))


@workload("validate_marker_map", f"WITH {PROBLEMS} SELECT * FROM problems WHERE problem IS NOT NULL")
def validate_marker_map(spark, sf):
    return M.validate_marker_map(I.edited_map(spark, sf), I.registry(spark, sf))


@workload(
    "flag_to_review",
    f"""WITH {PROBLEMS} SELECT original_name, mapped_canonical_name, keep_for_analysis,
            CASE WHEN bad AND {STATUS} <> 'REVIEW' THEN 'REVIEW' ELSE status END AS status, bad AND {STATUS} <> 'REVIEW' AS changed
        FROM (SELECT *, original_name IN (SELECT original_name FROM problems WHERE problem IS NOT NULL) AS bad FROM edited_map)""",
)
def flag_to_review(spark, sf):
    return M.flag_to_review(I.edited_map(spark, sf), I.registry(spark, sf))


@workload(
    "promote_reviewed",
    f"""SELECT original_name, mapped_canonical_name, keep_for_analysis, CASE WHEN p THEN 'RESOLVED' ELSE status END AS status, p AS promoted
        FROM (SELECT *, {STATUS} IN ('REVIEW', 'NOVEL') AND {MAPPED} IN (SELECT marker_name FROM registry) AS p FROM edited_map)""",
)
def promote_reviewed(spark, sf):
    return M.promote_reviewed(I.edited_map(spark, sf), I.registry(spark, sf))


@workload("resolve_marker_map", f"WITH {RESOLVED} SELECT * FROM resolved")
def resolve_marker_map(spark, sf):
    return M.resolve_marker_map(I.edited_map(spark, sf))


@workload(
    "marker_counts",
    f"""WITH {RESOLVED} SELECT COUNT(*) AS n_markers, COUNT(*) FILTER (level = 'RESOLVED') AS n_resolved,
            COUNT(*) FILTER (level = 'NOVEL') AS n_novel, COUNT(*) FILTER (level = 'REVIEW') AS n_review,
            string_agg(original_name, ',' ORDER BY original_name) FILTER (level = 'REVIEW') AS review_names FROM resolved""",
)
def marker_counts(spark, sf):
    return M.marker_counts(I.edited_map(spark, sf))


@workload(
    "readiness",
    f"""WITH {RESOLVED}, {PROBLEMS} SELECT n AS n_attention, CASE WHEN n > 0 THEN 'not ready' ELSE 'ready' END AS verdict
        FROM (SELECT COUNT(DISTINCT original_name) AS n FROM (
            SELECT original_name FROM resolved WHERE level = 'REVIEW' UNION ALL
            SELECT original_name FROM problems WHERE problem IS NOT NULL))""",
)
def readiness(spark, sf):
    return M.readiness(I.edited_map(spark, sf), I.registry(spark, sf))


SELECTION = M.Selection(include=("*ring*", "S*"), exclude=("*rod", "old?*"))


def glob_sql(x: str) -> str:
    inc = " OR ".join(f"{x} GLOB '{p.lower()}'" for p in SELECTION.include)
    exc = " OR ".join(f"{x} GLOB '{p.lower()}'" for p in SELECTION.exclude)
    return f"(({inc}) AND NOT ({exc}))"


@workload(
    "panel_keep",
    f"""SELECT original_name, mapped_canonical_name, status, CASE WHEN {glob_sql('e')} THEN 'yes' ELSE 'no' END AS keep_for_analysis
        FROM (SELECT *, {EFFECTIVE} AS e FROM edited_map)""",
)
def panel_keep(spark, sf):
    return M.apply_panel_keep(I.edited_map(spark, sf), SELECTION)


QC_SELECTION = M.Selection(include=("*", "*1", "dapi"), exclude=("empty*",))


@workload(
    "qc_drop",
    f"""SELECT original_name, mapped_canonical_name, status,
            CASE WHEN lower(original_name) LIKE '%hoechst%'
                 THEN CASE WHEN ((e GLOB '*1' OR e = 'dapi') AND NOT e GLOB 'empty*') OR e = 'hoechst2' THEN 'yes' ELSE 'no' END
                 WHEN lower(original_name) LIKE 'blank%' OR lower(original_name) LIKE 'empty%'
                 THEN CASE WHEN (e GLOB '*1' OR e = 'dapi') AND NOT e GLOB 'empty*' THEN 'yes' ELSE 'no' END
                 ELSE keep_for_analysis END AS keep_for_analysis
        FROM (SELECT *, {EFFECTIVE} AS e FROM edited_map)""",
)
def qc_drop(spark, sf):
    return M.drop_qc(I.edited_map(spark, sf), QC_SELECTION, nuclear_marker="Hoechst2")


@workload(
    "qc_flag",
    f"""SELECT slide_id, idx, raw, {qc_sql('raw')} AS is_qc,
            CASE WHEN COALESCE(keep, TRUE) THEN '' WHEN {qc_sql('raw')} THEN 'QC' ELSE 'user' END AS reason FROM panel""",
)
def qc_flag(spark, sf):
    return M.channel_notes(I.panel(spark, sf)).select("slide_id", "idx", "raw", "is_qc", "reason")


@workload("kept_channels", "SELECT slide_id, idx, marker FROM panel WHERE COALESCE(keep, TRUE)")
def kept_channels(spark, sf):
    return M.kept_channels(I.panel(spark, sf)).select("slide_id", "idx", "marker")


@workload("marker_glob_select", f"SELECT slide_id, idx, marker FROM panel WHERE COALESCE(keep, TRUE) AND {glob_sql('marker')}")
def marker_glob_select(spark, sf):
    return M.marker_glob_select(I.panel(spark, sf), SELECTION, strict=False).select("slide_id", "idx", "marker")


@workload(
    "selection_problems",
    f"""WITH k AS (SELECT * FROM panel WHERE COALESCE(keep, TRUE)), p AS (SELECT unnest({list(SELECTION.include + SELECTION.exclude)}) AS pattern)
        SELECT slide_id, pattern || ' matches no marker' AS problem FROM k CROSS JOIN p GROUP BY slide_id, pattern
        HAVING COUNT(*) FILTER (lower(marker) GLOB lower(pattern)) = 0
        UNION ALL SELECT slide_id, CASE WHEN COUNT(*) FILTER ({glob_sql('marker')}) = 0 THEN 'the selection leaves no channel' ELSE 'the selection leaves no nuclear stain' END
        FROM k GROUP BY slide_id HAVING COUNT(*) FILTER ({glob_sql('marker')} AND {nuclear_sql('marker')}) = 0""",
)
def selection_problems(spark, sf):
    return M.selection_problems(I.panel(spark, sf), SELECTION)


@workload(
    "unmatched_patterns",
    """SELECT pattern FROM (VALUES ('*ring*'), ('zz*'), ('dapi'), ('q?x')) t(pattern)
       WHERE NOT EXISTS (SELECT 1 FROM panel WHERE marker GLOB pattern)""",
)
def unmatched_patterns(spark, sf):
    return M.unmatched_patterns(I.panel(spark, sf), F.col("marker"), ["*ring*", "zz*", "dapi", "q?x"])


@workload(
    "required_markers_check",
    """SELECT slide_id, COALESCE(string_agg(r, ',' ORDER BY r), '') AS missing
       FROM (SELECT s.slide_id, CASE WHEN NOT list_contains(s.have, r) THEN r END AS r
             FROM (SELECT slide_id, list(lower(marker)) AS have FROM panel GROUP BY slide_id) s,
                  (VALUES ('dapi'), ('small_ring'), ('red_rod')) t(r)) GROUP BY slide_id""",
)
def required_markers_check(spark, sf):
    return M.required_missing(I.panel(spark, sf), ["DAPI", "small_ring", "red_rod"])


@workload(
    "apply_resolution",
    f"""WITH {RESOLVED} SELECT slide_id, idx, raw, hint,
            CASE WHEN r.original_name IS NULL THEN {clean_sql('c.raw')} ELSE {clean_sql('r.name')} END AS marker,
            COALESCE(r.level, 'REVIEW') AS match, COALESCE(r.keep, FALSE) AS keep
        FROM channels c LEFT JOIN (SELECT * FROM resolved WHERE keep) r ON r.original_name = c.raw""",
)
def apply_resolution(spark, sf):
    res = M.resolve_marker_map(I.edited_map(spark, sf)).filter("keep")
    return M.apply_resolution(I.channels(spark, sf), res)


@workload(
    "reapply_resolution",
    f"""WITH {RESOLVED} SELECT slide_id, idx, raw, hint,
            CASE WHEN r.original_name IS NULL THEN c.marker ELSE {clean_sql('r.name')} END AS marker,
            COALESCE(r.level, c.match) AS match, COALESCE(c.keep, TRUE) AS keep
        FROM panel c LEFT JOIN (SELECT * FROM resolved WHERE keep) r ON r.original_name = c.raw""",
)
def reapply_resolution(spark, sf):
    res = M.resolve_marker_map(I.edited_map(spark, sf)).filter("keep")
    applied = M.apply_resolution(I.panel(spark, sf), res, fresh=False)
    return applied.withColumn("keep", F.coalesce("keep", F.lit(True)))


@workload(
    "panel_covered",
    """SELECT raw, COUNT(DISTINCT slide_id) AS n_slides FROM panel
       WHERE COALESCE(keep, TRUE) AND raw NOT IN (SELECT original_name FROM edited_map WHERE status <> 'RESOLVED') GROUP BY raw""",
)
def panel_covered(spark, sf):
    return M.panel_uncovered(I.panel(spark, sf), I.edited_map(spark, sf).filter("status <> 'RESOLVED'"))


@workload(
    "nuclear_check",
    f"""SELECT *, CASE WHEN n_kept = 0 THEN 'no_kept_channel' ELSE 'no_nuclear' END AS problem FROM (
            SELECT slide_id, COUNT(*) FILTER (COALESCE(keep, TRUE)) AS n_kept,
                   COUNT(*) FILTER (COALESCE(keep, TRUE) AND {nuclear_sql('marker')}) AS n_nuclear
            FROM panel GROUP BY slide_id) WHERE n_kept = 0 OR n_nuclear = 0""",
)
def nuclear_check(spark, sf):
    return M.nuclear_check(I.panel(spark, sf))


@workload(
    "first_nuclear",
    f"""SELECT slide_id, arg_min(marker, r) AS nuclear_marker, arg_min(idx, r) AS nuclear_idx FROM (
            SELECT *, CASE WHEN marker = 'small_ring' THEN 0 ELSE 2 END * 1000 + CASE WHEN COALESCE(keep, TRUE) THEN 0 ELSE 1 END * 100 + idx AS r
            FROM panel WHERE marker = 'small_ring' OR {nuclear_sql('marker')}) GROUP BY slide_id""",
)
def first_nuclear(spark, sf):
    return M.first_nuclear(I.panel(spark, sf).withColumn("stored_nuclear", F.lit("small_ring")))


@workload(
    "nuclear_channel",
    f"""SELECT slide_id, COALESCE(arg_min(marker, idx) FILTER ({nuclear_sql('marker')}), '') AS nuclear_marker,
            COALESCE(MIN(idx) FILTER ({nuclear_sql('marker')}), -1) AS nuclear_idx FROM panel GROUP BY slide_id""",
)
def nuclear_channel(spark, sf):
    """Every slide of the cohort, those without a stain as -1."""
    return M.nuclear_channel(I.panel(spark, sf), strict=False).fillna({"nuclear_marker": "", "nuclear_idx": -1})


#: Two names every slide has, one of them by an alias.
NAMED = "named AS (SELECT slide_id, CAST(k AS INT) AS place, ['Every One', 'e1'][k + 1] AS name, 900 AS idx, 'every_one' AS marker, ['exact', 'alias'][k + 1] AS level FROM (SELECT DISTINCT slide_id FROM panel), range(2) t(k))"


@workload("named_channels", f"WITH {NAMED} SELECT * FROM named")
def named_channels(spark, sf):
    panel = I.panel(spark, sf).select("slide_id", "idx", "marker")
    common = panel.select("slide_id").distinct().select("slide_id", F.lit(900).alias("idx"), F.lit("every_one").alias("marker"))
    aliases = spark.createDataFrame([("E1", "every-one"), ("other", "none")], "alias string, name string")
    return M.named_channels(panel.unionByName(common), ["Every One", "e1"], aliases)


COMPLETED = "completed AS (SELECT DISTINCT CAST(slide_id AS INT) AS slide_id, stage FROM task_events WHERE status = 'completed' AND stage IN ('tissue', 'cells', 'patch', 'extract'))"


@workload(
    "marker_drift",
    f"""WITH {RESOLVED}, {COMPLETED}, stale AS (
            SELECT slide_id, string_agg(stage, ',' ORDER BY stage) AS stale_stages FROM completed GROUP BY slide_id)
        SELECT p.slide_id, idx, marker AS stored, {clean_sql('r.name')} AS expected, COALESCE(stale_stages, '') AS stale_stages
        FROM panel p JOIN resolved r ON r.original_name = p.raw LEFT JOIN stale s ON s.slide_id = p.slide_id
        WHERE marker <> {clean_sql('r.name')}""",
)
def marker_drift(spark, sf):
    done = I.task_events(spark, sf).filter("status = 'completed' AND stage IN ('tissue', 'cells', 'patch', 'extract')")
    done = done.select(F.col("slide_id").cast("int").alias("slide_id"), "stage")
    return M.marker_drift(I.panel(spark, sf), M.resolve_marker_map(I.edited_map(spark, sf)), done)


@workload(
    "nuclear_drift",
    f"""WITH {RESOLVED}, stored AS (
            SELECT p.*, CASE WHEN slide_id % 2 = 0 THEN 'dapi' ELSE 'small_ring' END AS sn FROM panel p),
        held AS (SELECT slide_id, arg_min(idx, idx) AS hidx, arg_min(COALESCE(keep, FALSE), idx) AS hk FROM stored WHERE marker = sn GROUP BY slide_id),
        e AS (SELECT s.slide_id, s.idx, s.keep, CASE WHEN r.original_name IS NULL THEN s.marker ELSE {clean_sql('r.name')} END AS em,
                     h.hk AND h.hidx = s.idx AS is_held
              FROM stored s LEFT JOIN resolved r ON r.original_name = s.raw LEFT JOIN held h ON h.slide_id = s.slide_id),
        nowd AS (SELECT slide_id, arg_min(em, CASE WHEN COALESCE(is_held, FALSE) THEN 0 ELSE 2 END * 1000
                          + CASE WHEN COALESCE(keep, TRUE) THEN 0 ELSE 1 END * 100 + idx) AS expected_nuclear
                 FROM e WHERE COALESCE(is_held, FALSE) OR {nuclear_sql('em')} GROUP BY slide_id)
        SELECT b.slide_id, b.sn AS stored_nuclear, expected_nuclear
        FROM (SELECT DISTINCT slide_id, sn FROM stored) b LEFT JOIN nowd n ON n.slide_id = b.slide_id
        WHERE b.sn IS DISTINCT FROM expected_nuclear""",
)
def nuclear_drift(spark, sf):
    stored = F.when(F.col("slide_id") % 2 == 0, F.lit("dapi")).otherwise(F.lit("small_ring"))
    panel = I.panel(spark, sf).withColumn("stored_nuclear", stored)
    return M.nuclear_drift(panel, M.resolve_marker_map(I.edited_map(spark, sf)))


@workload(
    "per_channel_hint",
    f"""WITH {IDX} SELECT folder, COUNT(*) AS n_files, COUNT(i.key) AS n_markers, COUNT(i.key) >= 2 AND COUNT(i.key) * 2 >= COUNT(*) AS looks_per_channel
        FROM (SELECT slide_id AS folder, CASE WHEN hint IN ('PROMO', 'LARGE') THEN raw || '_scan' ELSE raw END AS stem FROM channels) s
        LEFT JOIN idx i ON i.key = {key_sql('stem')} GROUP BY folder""",
)
def per_channel_hint(spark, sf):
    stem = F.when(F.col("hint").isin("PROMO", "LARGE"), F.concat("raw", F.lit("_scan"))).otherwise(F.col("raw"))
    stems = I.channels(spark, sf).select(F.col("slide_id").alias("folder"), stem.alias("stem"))
    return M.per_channel_hint(stems, _index(spark, sf))


@workload(
    "heterogeneous_channels",
    """SELECT slide_id, raw AS missing FROM (SELECT DISTINCT slide_id FROM channels), (SELECT DISTINCT raw FROM channels)
       EXCEPT SELECT slide_id, raw FROM channels""",
)
def heterogeneous_channels(spark, sf):
    return M.heterogeneous_channels(I.channels(spark, sf))


@workload(
    "channel_dups",
    "SELECT slide_id, COUNT(*) AS n_channels, COUNT(DISTINCT marker) AS n_unique, COUNT(*) - COUNT(DISTINCT marker) AS n_duplicates FROM panel GROUP BY slide_id",
)
def channel_dups(spark, sf):
    return M.channel_duplicates(I.panel(spark, sf))


@workload(
    "panel_intersect",
    f"""SELECT slide_id, {clean_sql('raw')} AS marker FROM channels WHERE hint IN ('ECONOMY', 'SMALL', 'LARGE')
        INTERSECT SELECT slide_id, marker FROM panel WHERE COALESCE(keep, TRUE)""",
)
def panel_intersect(spark, sf):
    wanted = I.channels(spark, sf).filter("hint IN ('ECONOMY', 'SMALL', 'LARGE')").select("slide_id", N.clean_marker(F.col("raw")).alias("marker"))
    return M.panel_intersect(wanted, I.panel(spark, sf))


FAMILIES = "CASE family WHEN 'ECONOMY' THEN 'epithelial_marker' WHEN 'PROMO' THEN 'ecm_matrix' WHEN 'LARGE' THEN 'qc_mask' ELSE 'immune' END"


def _families(spark, sf):
    family = (
        F.when(F.col("family") == "ECONOMY", "epithelial_marker")
        .when(F.col("family") == "PROMO", "ecm_matrix")
        .when(F.col("family") == "LARGE", "qc_mask")
        .otherwise("immune")
    )
    return M.registry_index(I.registry(spark, sf).withColumn("family", family))


@workload(
    "structural_channels",
    f"""SELECT slide_id, idx, marker, 'family' AS source FROM panel p
        JOIN (SELECT {clean_sql('marker_name')} AS n, {FAMILIES} AS f FROM registry) r ON r.n = p.marker
        WHERE f IN ('epithelial_marker', 'ecm_matrix') AND NOT {nuclear_sql('marker')}""",
)
def structural_channels(spark, sf):
    return M.structural_channels(I.panel(spark, sf), _families(spark, sf))


@workload(
    "non_qc_channels",
    f"""SELECT slide_id, idx, marker FROM panel p WHERE marker NOT IN (
            SELECT {clean_sql('marker_name')} FROM registry WHERE family = 'LARGE')""",
)
def non_qc_channels(spark, sf):
    return M.non_qc_channels(I.panel(spark, sf), _families(spark, sf)).select("slide_id", "idx", "marker")


LOOKUP = "lookup AS (SELECT name AS cand, name AS target, 0 AS kind FROM vocabulary UNION ALL SELECT alias, name, 1 FROM aliases)"
CASCADE = f"""{LOOKUP}, names AS (SELECT DISTINCT raw, {clean_sql('raw')} AS cleaned FROM channels),
    cands AS (SELECT raw, unnest(l) AS cand, unnest(range(0, len(l))) AS step FROM (
        SELECT raw, [cleaned] || string_split(cleaned, '_') || [regexp_replace(cleaned, '_\\d+[a-z]*', '', 'g')] AS l FROM names)),
    hits AS (SELECT raw, arg_min(target, step * 2 + kind) AS target, arg_min(step, step * 2 + kind) AS step, arg_min(kind, step * 2 + kind) AS kind
             FROM cands JOIN lookup USING (cand) GROUP BY raw),
    cascade AS (SELECT n.raw, COALESCE(target, cleaned) AS norm,
        CASE WHEN target IS NULL THEN 'none' WHEN step = 0 AND kind = 0 THEN 'exact' WHEN step = 0 THEN 'alias'
             WHEN step <= len(string_split(cleaned, '_')) THEN 'part' ELSE 'isotope' END AS level
        FROM names n LEFT JOIN hits h ON h.raw = n.raw)"""


@workload("vocab_cascade", f"WITH {CASCADE} SELECT * FROM cascade")
def vocab_cascade(spark, sf):
    return M.vocab_cascade(I.channels(spark, sf), I.vocabulary(spark, sf), I.aliases(spark, sf), fuzzy_cutoff=None)


@workload("ratcliff_ratio")
def ratcliff_ratio(spark, sf):
    """Every cascade step, the similarity step included."""
    return M.vocab_cascade(I.channels(spark, sf), I.vocabulary(spark, sf), I.aliases(spark, sf))


@workload("canonical_cascade")
def canonical_cascade(spark, sf):
    return M.canonical_cascade(I.channels(spark, sf), I.vocabulary(spark, sf), I.aliases(spark, sf))


@workload(
    "vocab_ids",
    f"""WITH {CASCADE}, p AS (SELECT slide_id, idx, c.raw, CASE WHEN slide_id % 2 = 0 AND {clean_sql('c.raw')} = 'small_ring' THEN 'dapi' ELSE norm END AS norm
            FROM channels c JOIN cascade USING (raw)),
        j AS (SELECT p.*, v.marker_id AS vid, v.mean, v.std, v.name IS NOT NULL AS in_vocab FROM p LEFT JOIN vocabulary v ON v.name = p.norm),
        free AS (SELECT i, row_number() OVER (ORDER BY i) AS n FROM range(103, 256, 2) t(i) WHERE i NOT IN (SELECT marker_id FROM vocabulary))
        SELECT slide_id, idx, raw, norm, CAST(CASE WHEN in_vocab THEN vid ELSE f.i END AS INT) AS marker_id,
               COALESCE(mean, 0.1::DOUBLE) AS mean, COALESCE(std, 0.2::DOUBLE) AS std, in_vocab
        FROM (SELECT *, row_number() OVER (PARTITION BY slide_id, in_vocab ORDER BY idx) AS n FROM j) j LEFT JOIN free f ON f.n = j.n""",
)
def vocab_ids(spark, sf):
    ch, vocab = I.channels(spark, sf), I.vocabulary(spark, sf)
    resolved = M.vocab_cascade(ch, vocab, I.aliases(spark, sf), fuzzy_cutoff=None)
    panel = ch.withColumn("nuclear_marker", F.when(F.col("slide_id") % 2 == 0, F.lit("Small Ring")))
    return M.vocab_ids(panel, vocab, resolved, 0.1, 0.2)


@workload(
    "eva_style_vocab",
    """WITH lookup AS (
            SELECT key, arg_max(name, pos) AS target FROM (
                SELECT REPLACE(REPLACE(lower(name), '-', '_'), ' ', '_') AS key, name, pos FROM vocabulary UNION ALL
                SELECT REPLACE(REPLACE(REPLACE(lower(name), '-', ''), ' ', ''), '_', ''), name, pos FROM vocabulary UNION ALL
                SELECT alias, name, 4611686018427387904 FROM aliases) GROUP BY key),
        m AS (SELECT c.slide_id, c.idx, c.raw, REPLACE(REPLACE(lower(raw), '-', '_'), ' ', '_') AS k1,
                     REPLACE(REPLACE(REPLACE(lower(raw), '-', ''), ' ', ''), '_', '') AS k2 FROM channels c)
       SELECT slide_id, idx, raw, status, CASE WHEN status = 'kept' THEN found END AS vocab_name FROM (
            SELECT m.*, COALESCE(a.target, b.target) AS found,
                   CASE WHEN regexp_matches(k1, 'hoechst|empty|blank|draq') THEN 'skipped'
                        WHEN COALESCE(a.target, b.target) IN (SELECT name FROM vocabulary) THEN 'kept' ELSE 'dropped' END AS status
            FROM m LEFT JOIN lookup a ON a.key = k1 LEFT JOIN lookup b ON b.key = k2)""",
)
def eva_style_vocab(spark, sf):
    return M.compact_vocab(I.channels(spark, sf).drop("hint"), I.vocabulary(spark, sf), I.aliases(spark, sf))


@workload(
    "novel_markers",
    f"""SELECT slide_id, idx, marker FROM panel WHERE {key_sql('marker')} <> 'smallgear'
        AND {key_sql('marker')} NOT IN (SELECT {key_sql('name')} FROM vocabulary)""",
)
def novel_markers(spark, sf):
    panel = I.panel(spark, sf).withColumn("nuclear_marker", F.lit("Small Gear"))
    return M.novel_markers(panel, I.vocabulary(spark, sf)).select("slide_id", "idx", "marker")


@workload(
    "missing_rows",
    f"""SELECT key, CAST(FLOOR(MIN(slide_id * 1000 + idx) / 1000) AS INT) AS slide_id, MIN(slide_id * 1000 + idx) % 1000 AS idx,
            arg_min(marker, slide_id * 1000 + idx) AS marker
        FROM (SELECT *, {key_sql('marker')} AS key FROM panel)
        WHERE key NOT IN (SELECT {key_sql('marker_name')} FROM registry) GROUP BY key""",
)
def missing_rows(spark, sf):
    return M.missing_rows(I.panel(spark, sf), I.registry(spark, sf))


@workload(
    "marker_set_equal",
    """SELECT slide_id, CASE WHEN a = b THEN 'skip' ELSE 'error' END AS action FROM (
            SELECT slide_id, COALESCE(string_agg(DISTINCT marker, ',' ORDER BY marker) FILTER (COALESCE(keep, TRUE)), '') AS a,
                   COALESCE(string_agg(DISTINCT marker, ',' ORDER BY marker) FILTER (hint <> 'LARGE' OR idx < 10), '') AS b
            FROM panel GROUP BY slide_id)""",
)
def marker_set_equal(spark, sf):
    from histoframe.operators.features import compare_marker_sets

    panel = I.panel(spark, sf)
    stored = M.kept_channels(panel).groupBy("slide_id").agg(F.collect_set("marker").alias("markers_used"))
    asked = panel.filter("hint <> 'LARGE' OR idx < 10").groupBy("slide_id").agg(F.collect_set("marker").alias("requested"))
    return compare_marker_sets(stored, asked, ["slide_id"]).select("slide_id", "action")

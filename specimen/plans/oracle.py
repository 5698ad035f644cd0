"""DuckDB SQL oracles, one per query of ``specimen.plans.queries``.

The carrier views are the SQL of FIXTURES.md.  Pixel operators are checked
through their relational twins: images in long form (image_id, h, w, y, x,
r, g, b), each kernel written as index arithmetic, joins and windows, and the
result reduced to the same exact per-image digest the Spark side computes.
"""

from __future__ import annotations

from specimen.functions.kernels import gaussian_weights
from specimen.schema import VARIANTS

ORACLES: dict[str, str] = {}

_SUFFIX_LIST = ", ".join(f"'{v[1]}'" for v in VARIANTS)
_SUFFIX_ALT = "|".join(v[1] for v in VARIANTS)
_STEM_RE = "^(.*?)([.][^./]*)?$"


def _d(x) -> str:
    """A DOUBLE literal (plain literals are DECIMAL in DuckDB)."""
    return f"CAST('{x}' AS DOUBLE)"


# ---------------------------------------------------------------- carrier views

BASE = rf"""
v_meta AS (
  SELECT concat('IMG_', CAST(d.doc_id AS VARCHAR)) AS image_id,
         CASE WHEN d.doc_id % 23 = 5 THEN NULL WHEN d.doc_id % 29 = 4 THEN 'bcc' ELSE d.lang END AS dx,
         CASE l.quality WHEN 1 THEN 'histo' WHEN 0 THEN 'follow_up' END AS dx_type,
         CASE WHEN d.doc_id % 17 = 3 THEN NULL WHEN l.toxic = 1 THEN 'female' WHEN l.toxic = 0 THEN 'male' END AS sex,
         CASE WHEN l.quality IS NULL THEN NULL ELSE CAST(d.n_chars AS DOUBLE) END AS age,
         d.source AS localization
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL
  SELECT concat('IMG_', CAST(doc_id AS VARCHAR)), lang, NULL, NULL, NULL, source
  FROM documents WHERE doc_id % 50 = 7),
v_raw_meta AS (
  SELECT concat('LES_', CAST(num % 97 AS VARCHAR)) AS lesion_id, image_id, dx, dx_type, sex,
         CASE WHEN age IS NULL THEN NULL WHEN num % 40 = 11 THEN 'unknown'
              ELSE CAST(CAST(age AS BIGINT) AS VARCHAR) END AS age,
         localization
  FROM (SELECT *, CAST(regexp_extract(image_id, '(\d+)$', 1) AS BIGINT) AS num FROM v_meta)),
v_catalog AS (
  SELECT concat('/img/part_', CAST(1 + vec_id % 2 AS VARCHAR), '/IMG_', CAST(vec_id AS VARCHAR),
                CASE vec_id % 3 WHEN 0 THEN '.jpg' WHEN 1 THEN '.JPG' ELSE '.jpeg' END) AS path,
         CAST(1 + vec_id % 2 AS INTEGER) AS part
  FROM embeddings WHERE vec_id % 25 <> 24
  UNION ALL
  SELECT concat('/img/part_', CAST(2 - vec_id % 2 AS VARCHAR), '/IMG_', CAST(vec_id AS VARCHAR), '.jpeg'),
         CAST(2 - vec_id % 2 AS INTEGER)
  FROM embeddings WHERE vec_id % 5 = 0
  UNION ALL
  SELECT concat('/img/part_1/IMG_', CAST(vec_id AS VARCHAR),
                list_extract([{_SUFFIX_LIST}], CAST((vec_id // 7) % 9 + 1 AS INTEGER)), '.jpg'), CAST(1 AS INTEGER)
  FROM embeddings WHERE vec_id % 7 = 0),
v_listing AS (
  SELECT path FROM v_catalog
  UNION ALL
  SELECT concat('/img/incoming/IMG_', CAST(vec_id AS VARCHAR),
                CASE WHEN vec_id % 2 = 0 THEN '.jpg' ELSE '.JPEG' END)
  FROM embeddings WHERE vec_id % 25 = 24
  UNION ALL
  SELECT concat('/img/part_10/IMG_', CAST(vec_id AS VARCHAR), '.jpg') FROM embeddings WHERE vec_id % 13 = 0
  UNION ALL
  SELECT concat('/img/incoming/IMG_', CAST(vec_id AS VARCHAR), '.png') FROM embeddings WHERE vec_id % 11 = 0),
v_parsed AS (
  SELECT path, name, regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent,
         regexp_extract(path, '{_STEM_RE}', 2) AS ext,
         regexp_extract(name, '{_STEM_RE}', 1) AS image_id,
         NULLIF(regexp_extract(name, '({_SUFFIX_ALT})[.][^./]*$', 1), '') AS variant
  FROM (SELECT path, regexp_extract(path, '[^/]*$', 0) AS name FROM v_listing)),
v_images AS (
  SELECT * FROM v_parsed WHERE regexp_matches(path, '(?i)\.jpe?g$')),
v_cat_parsed AS (
  SELECT * FROM v_parsed WHERE path IN (SELECT path FROM v_catalog)),
v_resolved AS (
  SELECT image_id, arg_min(path, rnk) AS img_path FROM (
    SELECT image_id, path,
           (CASE parent WHEN '/img/part_1' THEN 0 WHEN '/img/part_2' THEN 1 END) * 3 +
           (CASE ext WHEN '.jpg' THEN 0 WHEN '.JPG' THEN 1 WHEN '.jpeg' THEN 2 END) AS rnk
    FROM v_cat_parsed) WHERE rnk IS NOT NULL GROUP BY image_id),
v_cast AS (
  SELECT CAST(image_id AS VARCHAR) AS image_id, dx, dx_type, sex, TRY_CAST(age AS DOUBLE) AS age,
         localization FROM v_raw_meta),
v_enriched AS (
  SELECT m.image_id, m.dx, m.dx_type, m.sex, m.age, m.localization, r.img_path
  FROM v_cast m LEFT JOIN v_resolved r ON m.image_id = r.image_id),
v_qids AS (
  SELECT DISTINCT image_id FROM v_enriched WHERE age IS NULL AND img_path IS NOT NULL),
v_clean AS (
  SELECT e.* FROM v_enriched e
  WHERE e.age IS NOT NULL AND e.img_path IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM v_qids q WHERE q.image_id = e.image_id)),
v_originals AS (
  SELECT * FROM v_images WHERE parent IN ('/img/part_1', '/img/part_2') AND variant IS NULL),
v_unlabelled AS (
  SELECT o.image_id, o.path FROM v_originals o
  WHERE NOT EXISTS (SELECT 1 FROM v_meta m WHERE m.dx IS NOT NULL AND m.image_id = o.image_id)),
v_variants AS (
  SELECT * FROM (VALUES {", ".join(f"({i + 1}, '{n}', '{s}')" for i, (n, s, _) in enumerate(VARIANTS))})
  t(variant_rank, transform, variant))
"""


def sql(final: str, extra: str = "") -> str:
    ctes = BASE.strip() + ("," + extra if extra else "")
    return f"WITH {ctes}\n{final}"


def register(name: str, final: str, extra: str = "") -> None:
    ORACLES[name] = sql(final, extra)


# ---------------------------------------------------------------- 2.1 sources

register("scan_csv_metadata", "SELECT * FROM v_meta")
register("scan_image_catalog", "SELECT path, name, parent, ext, image_id, variant FROM v_images")
register("locate_file_ci", """
SELECT lower(regexp_extract(path, '[^/]*$', 0)) AS name_lower, min(path) AS first_path,
       count(*) AS n_matches FROM v_listing GROUP BY 1""")
register("dataset_ready", """
SELECT m.present AS metadata_present, c.p1 AS part1_images, c.p2 AS part2_images,
       m.present AND (c.p1 > 0 OR c.p2 > 0) AS ready
FROM (SELECT count(*) > 0 AS present FROM v_meta) m,
     (SELECT count(*) FILTER (WHERE parent = '/img/part_1' AND regexp_matches(name, '^.*\\.jp.*g$')) AS p1,
             count(*) FILTER (WHERE parent = '/img/part_2' AND regexp_matches(name, '^.*\\.jp.*g$')) AS p2
      FROM v_parsed) c""")
_TODO = """v_todo AS (
  SELECT DISTINCT path FROM v_listing WHERE (path LIKE '%.jpg' OR path LIKE '%.JPG' OR path LIKE '%.jpeg')
    AND regexp_extract(path, '^(.*)/[^/]*$', 1) NOT IN ('/img/part_1', '/img/part_2'))"""
register("organize_parts", """
SELECT path, CAST(ntile(2) OVER (ORDER BY path) AS INTEGER) AS part,
       concat(CASE WHEN ntile(2) OVER (ORDER BY path) = 1 THEN '/img/part_1' ELSE '/img/part_2' END,
              '/', regexp_extract(path, '[^/]*$', 0)) AS target_path
FROM v_todo""", _TODO)
_CLEAN_TYPES = [("image_id", "string"), ("dx", "string"), ("dx_type", "string"), ("sex", "string"),
                ("age", "double"), ("localization", "string"), ("img_path", "string")]
register("schema_report", "UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, "
    f"true AS nullable, count({c}) AS non_null FROM v_clean\n"
    for i, (c, t) in enumerate(_CLEAN_TYPES)))
register("materialize_once", "SELECT * FROM v_clean")

# ---------------------------------------------------------------- 2.2 projections, filters

register("project_metadata", "SELECT image_id, dx, dx_type, sex, age, localization FROM v_raw_meta")
register("cast_id_string", "SELECT image_id FROM v_cast")
register("cast_age_double",
         "SELECT image_id, age AS age_text, TRY_CAST(age AS DOUBLE) AS age FROM v_raw_meta")
register("with_img_path", "SELECT * FROM v_enriched")
register("null_label", "SELECT image_id, coalesce(sex, 'NULL') AS sex_label FROM v_enriched")
register("filter_age_present", "SELECT * FROM v_enriched WHERE age IS NOT NULL")
register("filter_has_image", "SELECT * FROM v_enriched WHERE img_path IS NOT NULL")
register("filter_age_missing", "SELECT * FROM v_enriched WHERE age IS NULL")
register("filter_null_any", "SELECT * FROM v_enriched WHERE dx_type IS NULL")
register("sample_fraction", """
SELECT * FROM v_enriched
WHERE CAST(('0x' || substr(md5(coalesce(image_id, '')), 1, 8)) AS BIGINT) < 4294967296.0 * 0.05""")
register("filter_path_exists",
         "SELECT * FROM v_enriched e WHERE e.img_path IN (SELECT path FROM v_listing)")
register("quarantine_null_age",
         "SELECT image_id, img_path, 'null_age' AS reason FROM v_enriched WHERE age IS NULL")
register("clean_and_enrich", "SELECT * FROM v_clean")
register("skip_missing_image", """
SELECT image_id, img_path,
       (img_path IS NULL OR img_path = '' OR img_path NOT IN (SELECT path FROM v_listing)) AS skipped
FROM v_enriched""")

# ---------------------------------------------------------------- 2.3 joins

register("resolve_image_path", "SELECT image_id, img_path FROM v_resolved")
register("images_with_metadata", """
SELECT * FROM v_cast m WHERE m.image_id IN (SELECT image_id FROM v_resolved)""")
register("metadata_without_image", """
SELECT * FROM v_cast m WHERE NOT EXISTS (SELECT 1 FROM v_resolved r WHERE r.image_id = m.image_id)""")
register("images_without_label", "SELECT image_id, path FROM v_unlabelled")
register("anti_quarantine", """
SELECT * FROM v_enriched e WHERE NOT EXISTS (SELECT 1 FROM v_qids q WHERE q.image_id = e.image_id)""")
register("candidate_paths", """
SELECT image_id, CAST(pos AS INTEGER) AS pos, concat(d, '/', image_id, ext) AS candidate
FROM v_raw_meta,
     (VALUES (0, '/img/part_1', '.jpg'), (1, '/img/part_1', '.JPG'), (2, '/img/part_1', '.jpeg'),
             (3, '/img/part_2', '.jpg'), (4, '/img/part_2', '.JPG'), (5, '/img/part_2', '.jpeg')) c(pos, d, ext)
WHERE image_id IS NOT NULL""")

# ---------------------------------------------------------------- 2.4 aggregations


def _pct(n: str, total: str) -> str:
    return f"CAST({n} AS DOUBLE) / CAST({total} AS DOUBLE) * {_d(100.0)}"


def _pct_text(n: str, total: str) -> str:
    num, den = f"({n} * 10000)", f"({total})"
    q = f"CAST(floor(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)) AS BIGINT)"
    r = f"({num} - {q} * {den})"
    cents = (f"({q} + CASE WHEN 2 * {r} > {den} THEN 1 "
             f"WHEN 2 * {r} = {den} AND {q} % 2 = 1 THEN 1 ELSE 0 END)")
    return (f"concat(CAST({cents} // 100 AS VARCHAR), '.', "
            f"lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))")


def _freq(col: str) -> str:
    return f"""
SELECT value, n, {_pct('n', 't.total')} AS percent, {_pct_text('n', 't.total')} AS percent_text,
       row_number() OVER (ORDER BY n DESC, value ASC) AS rank
FROM (SELECT coalesce(CAST({col} AS VARCHAR), 'NULL') AS value, count(*) AS n FROM v_clean GROUP BY 1) g,
     (SELECT count(*) AS total FROM v_clean) t"""


_REPORT = """v_report AS (
  SELECT column_name, upper(column_name) AS title, value, n, """ + _pct("n", "t.total") + """ AS percent,
         """ + _pct_text("n", "t.total") + """ AS percent_text,
         row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value ASC) AS rank
  FROM (SELECT column_name, value, count(*) AS n FROM (
          SELECT 'dx' AS column_name, coalesce(dx, 'NULL') AS value FROM v_clean
          UNION ALL SELECT 'dx_type', coalesce(dx_type, 'NULL') FROM v_clean
          UNION ALL SELECT 'sex', coalesce(sex, 'NULL') FROM v_clean
          UNION ALL SELECT 'localization', coalesce(localization, 'NULL') FROM v_clean) u
        GROUP BY column_name, value) g,
       (SELECT count(*) AS total FROM v_clean) t)"""

_STATS = """v_stats AS (
  SELECT column_name, count(*) AS total_rows, count(*) - count(value) AS null_count,
         count(DISTINCT value) AS n_distinct
  FROM (SELECT 'dx' AS column_name, dx AS value FROM v_clean
        UNION ALL SELECT 'dx_type', dx_type FROM v_clean
        UNION ALL SELECT 'sex', sex FROM v_clean
        UNION ALL SELECT 'localization', localization FROM v_clean) u GROUP BY column_name)"""

register("row_count", "SELECT count(*) AS n_rows FROM v_clean")
register("cleaning_delta", """
SELECT count(*) AS rows_before, count(*) FILTER (WHERE kept) AS rows_after,
       count(*) FILTER (WHERE NOT kept) AS rows_removed,
       count(*) FILTER (WHERE age IS NULL) AS removed_null_age,
       count(*) FILTER (WHERE age IS NOT NULL AND img_path IS NULL) AS removed_no_image,
       count(*) FILTER (WHERE q AND age IS NOT NULL AND img_path IS NOT NULL) AS removed_quarantined_id,
       (SELECT count(*) FROM v_raw_meta WHERE age IS NOT NULL AND TRY_CAST(age AS DOUBLE) IS NULL)
         AS age_cast_failures
FROM (SELECT e.*, q.image_id IS NOT NULL AS q,
             e.age IS NOT NULL AND e.img_path IS NOT NULL AND q.image_id IS NULL AS kept
      FROM v_enriched e LEFT JOIN v_qids q ON e.image_id = q.image_id)""")
_ENR_COLS = ["image_id", "dx", "dx_type", "sex", "age", "localization", "img_path"]
register("null_counts", " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, count(*) - count({c}) AS null_count "
    f"FROM v_enriched" for i, c in enumerate(_ENR_COLS)))
register("null_count_column",
         "SELECT 'sex' AS column_name, count(*) - count(sex) AS null_count FROM v_enriched")
register("distinct_values", "SELECT DISTINCT dx AS value FROM v_clean WHERE dx IS NOT NULL")
register("class_frequency", _freq("dx"))
register("frequency_report", "SELECT * FROM v_report", _REPORT)
register("column_stats", "SELECT * FROM v_stats", _STATS)
register("describe_age", f"""
SELECT count(age) AS count, round(avg(age), 6) AS mean, round(stddev_samp(age), 6) AS stddev,
       min(age) AS min, max(age) AS max FROM v_clean""")

# preprocessing / augmentation jobs on the synthetic images (junk: vec_id % 50 = 13)
_JOB = """v_job AS (
  SELECT c.*, CAST(regexp_extract(c.image_id, '(\\d+)$', 1) AS BIGINT) AS k,
         CAST(regexp_extract(c.image_id, '(\\d+)$', 1) AS BIGINT) IN (SELECT vec_id FROM embeddings) AS has_px
  FROM v_enriched c WHERE c.age IS NOT NULL),
v_status AS (
  SELECT *, CASE WHEN img_path IS NULL OR NOT has_px THEN 'SKIPPED' WHEN k % 50 = 13 THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM v_job)"""
register("status_counts", """
SELECT status, CASE status WHEN 'SUCCESS' THEN 'success' WHEN 'SKIPPED' THEN 'skipped' ELSE 'failed' END
       AS category, count(*) AS n FROM v_status GROUP BY status""", _JOB)
register("success_rate", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE status = 'SUCCESS') AS n_success,
       count(*) FILTER (WHERE status = 'SUCCESS') * """ + _d(100.0) + """ / NULLIF(count(*), 0)
       AS success_rate FROM v_status""", _JOB)
register("preprocess_dataset", """
SELECT image_id, img_path, status,
       CASE WHEN status = 'SUCCESS' THEN 128 END AS height,
       CASE WHEN status = 'SUCCESS' THEN 128 END AS width FROM v_status""", _JOB)
register("run_summary", f"""
SELECT count(*) AS n_rows,
       'image_id, dx, dx_type, sex, age, localization, img_path, status, error' AS columns,
       {_d(0.05)} AS sample_fraction FROM v_enriched WHERE age IS NOT NULL""")
register("variant_counts", """
SELECT variant_rank, variant, n FROM (
  SELECT v.variant_rank, v.variant, count(p.path) AS n
  FROM v_variants v LEFT JOIN v_parsed p ON p.variant = v.variant GROUP BY 1, 2
  UNION ALL
  SELECT 10, 'TOTAL', count(*) FROM v_parsed WHERE variant IS NOT NULL)""")
_NODES = """v_nodes AS (
  SELECT image_id, img_path, CASE WHEN row_number() OVER (ORDER BY img_path) <= n // 2 THEN 1 ELSE 2 END AS node
  FROM v_clean, (SELECT count(*) AS n FROM v_clean) t),
v_aug AS (
  SELECT n.image_id, n.node, v.variant,
         CAST(regexp_extract(n.image_id, '(\\d+)$', 1) AS BIGINT) % 50 <> 13 AS ok
  FROM v_nodes n, v_variants v
  WHERE CAST(regexp_extract(n.image_id, '(\\d+)$', 1) AS BIGINT) IN (SELECT vec_id FROM embeddings))"""
register("split_two_nodes", "SELECT image_id, img_path, node FROM v_nodes", _NODES)
register("augment_totals", """
SELECT node, count(DISTINCT image_id) AS originals, count(*) FILTER (WHERE ok) AS variants_ok,
       count(*) FILTER (WHERE NOT ok) AS variants_failed FROM v_aug GROUP BY node
UNION ALL
SELECT 0, count(DISTINCT image_id), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM v_aug""",
         _NODES)
register("augment_dataset", """
SELECT node, variant, count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE NOT ok) AS n_failed
FROM v_aug GROUP BY node, variant""", _NODES)
register("dataset_overview", """
SELECT 'images' AS metric, CAST(NULL AS VARCHAR) AS value, count(DISTINCT image_id) AS n FROM v_originals
UNION ALL SELECT 'without_label', NULL, count(DISTINCT image_id) FROM v_unlabelled
UNION ALL SELECT 'label', dx, count(*) FROM v_meta WHERE dx IS NOT NULL GROUP BY dx""")
_PROFILE_ROWS = []
for _i, (_c, _t) in enumerate(_CLEAN_TYPES):
    if _t == "double":
        _PROFILE_ROWS.append(
            f"SELECT {_i + 1} AS position, '{_c}' AS column_name, '{_t}' AS data_type, "
            f"count(*) - count({_c}) AS null_count, count({_c}) AS count, round(avg({_c}), 6) AS mean, "
            f"round(stddev_samp({_c}), 6) AS stddev, min({_c}) AS min, max({_c}) AS max FROM v_clean")
    else:
        _PROFILE_ROWS.append(
            f"SELECT {_i + 1} AS position, '{_c}' AS column_name, '{_t}' AS data_type, "
            f"count(*) - count({_c}) AS null_count, CAST(NULL AS BIGINT) AS count, "
            f"CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, "
            f"CAST(NULL AS DOUBLE) AS max FROM v_clean")
register("column_profile", "\nUNION ALL ".join(_PROFILE_ROWS))
_DEFICIT = """v_deficit AS (
  SELECT value, n, m.majority_n, m.majority_n - n AS deficit, n_images,
         greatest(m.majority_n - n - n_images * 9, 0) AS unfilled
  FROM (SELECT coalesce(dx, 'NULL') AS value, count(*) AS n, count(DISTINCT image_id) AS n_images
        FROM v_clean GROUP BY 1) g,
       (SELECT max(n) AS majority_n FROM (SELECT count(*) AS n FROM v_clean GROUP BY dx)) m)"""
register("class_deficit", "SELECT * FROM v_deficit", _DEFICIT)
register("balance_plan", """
SELECT value, image_id, variant, variant_rank, plan_rank FROM (
  SELECT i.value, i.image_id, v.variant, v.variant_rank, d.deficit,
         row_number() OVER (PARTITION BY i.value ORDER BY v.variant_rank, i.image_id) AS plan_rank
  FROM (SELECT DISTINCT coalesce(dx, 'NULL') AS value, image_id FROM v_clean WHERE image_id IS NOT NULL) i
  JOIN v_deficit d ON d.value = i.value, v_variants v
  WHERE d.deficit > 0)
WHERE plan_rank <= deficit""", _DEFICIT)

# ---------------------------------------------------------------- 2.6 sorts, 2.7 set ops, 2.8 scalar

register("order_by_count", "SELECT value, n, rank FROM (" + _freq("localization") + ")")
register("head_rows", """
SELECT column_name, value, n, rank FROM v_report ORDER BY column_name, rank LIMIT 20""", _REPORT)
register("union_listings", """
SELECT DISTINCT path FROM v_listing WHERE path LIKE '%.jpg' OR path LIKE '%.JPG' OR path LIKE '%.jpeg'""")
register("union_parts", """
SELECT d.part, d.part_dir, count(p.path) AS n_images
FROM (VALUES (1, '/img/part_1'), (2, '/img/part_2')) d(part, part_dir)
LEFT JOIN v_images p ON p.parent = d.part_dir GROUP BY 1, 2""")
register("images_to_organize", "SELECT path FROM v_todo", _TODO)
register("path_basename", "SELECT path, regexp_extract(path, '[^/]*$', 0) AS name FROM v_listing")
register("path_splitext", f"""
SELECT path, regexp_extract(path, '{_STEM_RE}', 1) AS stem, regexp_extract(path, '{_STEM_RE}', 2) AS ext
FROM v_listing""")
register("variant_path", f"""
SELECT c.image_id, v.variant,
       concat(regexp_extract(c.img_path, '{_STEM_RE}', 1), v.variant,
              regexp_extract(c.img_path, '{_STEM_RE}', 2)) AS variant_path
FROM v_clean c, v_variants v""")
register("lower_equals", """
SELECT path FROM v_parsed WHERE lower(name) = lower(concat(image_id, '.jpg'))""")
register("variant_family", """
SELECT p.path, p.variant, v.transform,
       CASE WHEN v.variant IN ('_rot90', '_rot180', '_rot270') THEN 'rotation'
            WHEN v.variant IN ('_bright', '_dark') THEN 'brightness'
            WHEN v.variant = '_hflip' THEN 'flip_horizontal' WHEN v.variant = '_vflip' THEN 'flip_vertical'
            ELSE 'zoom' END AS family
FROM v_parsed p JOIN v_variants v ON p.variant = v.variant""")
register("percent_of_total", "SELECT value, n, percent FROM (" + _freq("sex") + ")")
register("format_percent", "SELECT value, percent_text FROM (" + _freq("dx_type") + ")")
register("half_split_sizes", """
SELECT n, (n + 1) // 2 AS ceil_half, n // 2 AS floor_half FROM (SELECT count(*) AS n FROM v_todo)""", _TODO)
register("int_trunc", f"""
SELECT concat('IMG_', CAST(vec_id AS VARCHAR)) AS image_id,
       CAST(floor(h * {_d(0.03)}) AS INTEGER) AS border_y, CAST(floor(w * {_d(0.03)}) AS INTEGER) AS border_x,
       CAST(floor(h / {_d(1.2)}) AS INTEGER) AS zoom_in_h, CAST(floor(h * {_d(0.8)}) AS INTEGER) AS zoom_out_h,
       CAST(floor(w * {_d(0.15)}) AS INTEGER) AS pad_x
FROM (SELECT vec_id, 24 + vec_id % 9 AS h, 32 + (vec_id * 3) % 11 AS w FROM embeddings)""")
register("clamp", f"""
SELECT image_id, least(greatest(age, {_d(100.0)}), {_d(10000.0)}) AS age_clamped FROM v_clean""")
register("binary_label", """
SELECT CASE WHEN dx IS NULL THEN 'NULL' WHEN dx IN ('bcc') THEN 'malignant' ELSE 'benign' END AS label,
       count(*) AS n FROM v_clean GROUP BY 1""")
register("upper_title", "SELECT column_name, upper(column_name) AS title FROM v_stats", _STATS)


# ---------------------------------------------------------------- 2.9 pixel twins

PX_RECT = f"""px_rect AS (
  SELECT concat('IMG_', CAST(vec_id AS VARCHAR)) AS image_id, h, w, y, x,
         (vec_id * 7 + y * 13 + x * 29) % 256 AS r,
         (vec_id * 3 + y * 5 + x * 11 + 100) % 256 AS g,
         CAST(least({_d(255.0)}, greatest({_d(0.0)}, floor((CAST(embedding[((y * 8 + x) % 64) + 1] AS DOUBLE)
              + {_d(1.0)}) * {_d(127.5)}))) AS BIGINT) AS b
  FROM (SELECT vec_id, embedding, 24 + vec_id % 9 AS h, 32 + (vec_id * 3) % 11 AS w FROM embeddings) e,
       range(0, 32) ty(y), range(0, 43) tx(x)
  WHERE y < h AND x < w)"""

PX_SYNTH = """px_synth AS (
  SELECT concat('IMG_', CAST(k AS VARCHAR)) AS image_id, 64 AS h, 64 AS w, y, x,
         CASE WHEN hit THEN 110 ELSE 210 END + n AS r,
         CASE WHEN hit THEN 60 ELSE 180 END + n AS g,
         CASE WHEN hit THEN 50 ELSE 170 END + n AS b
  FROM (SELECT k, y, x, (k * 31 + y * 17 + x * 13) % 16 AS n,
               (x - cx) * (x - cx) + (y - cy) * (y - cy) <= r0 * r0 AS hit
        FROM (SELECT vec_id AS k, CASE WHEN vec_id % 10 = 0 THEN 2 ELSE 20 + (vec_id * 7) % 24 END AS cx,
                     20 + (vec_id * 11) % 24 AS cy, 8 + vec_id % 7 AS r0 FROM embeddings) e
        CROSS JOIN range(64) AS ty(y) CROSS JOIN range(64) AS tx(x)) p)"""


def digest_sql(src: str, keys: str = "image_id") -> str:
    wt = "((131 * y + 31 * x) % 1009 + 1)"
    return f"""
SELECT {keys}, CAST(h AS INTEGER) AS height, CAST(w AS INTEGER) AS width,
       CAST(sum(r) AS BIGINT) AS sum_r, CAST(sum(g) AS BIGINT) AS sum_g, CAST(sum(b) AS BIGINT) AS sum_b,
       CAST(sum({wt} * r) AS BIGINT) AS chk_r, CAST(sum({wt} * g) AS BIGINT) AS chk_g,
       CAST(sum({wt} * b) AS BIGINT) AS chk_b
FROM {src} GROUP BY {keys}, h, w"""


def _renamed(src: str) -> str:
    return f"(SELECT image_id, h AS sh, w AS sw, y AS sy, x AS sx, r, g, b FROM {src})"


def index_map(name: str, src: str, h: str, w: str, y: str, x: str, where: str = "TRUE") -> str:
    return (f"{name} AS (SELECT image_id, {h} AS h, {w} AS w, {y} AS y, {x} AS x, r, g, b "
            f"FROM {_renamed(src)} WHERE {where})")


def rot_sql(name, src, angle):
    if angle == 90:
        return index_map(name, src, "sw", "sh", "sw - 1 - sx", "sy")
    if angle == 180:
        return index_map(name, src, "sh", "sw", "sh - 1 - sy", "sw - 1 - sx")
    return index_map(name, src, "sw", "sh", "sx", "sh - 1 - sy")


def flip_sql(name, src, code):
    if code == 1:
        return index_map(name, src, "sh", "sw", "sy", "sw - 1 - sx")
    return index_map(name, src, "sh", "sw", "sh - 1 - sy", "sx")


def bright_sql(name, src, factor):
    def ch(c):
        return (f"CAST(least(255, round_even(abs(CAST({c} AS FLOAT) * CAST('{factor}' AS FLOAT)), 0)) "
                f"AS BIGINT) AS {c}")
    return f"{name} AS (SELECT image_id, h, w, y, x, {ch('r')}, {ch('g')}, {ch('b')} FROM {src})"


def _coef(name: str, geom: str, size: str, dst: str, off: str, mode: str) -> str:
    """Per output coordinate d: source indices i0, i1 (with offset) and weights."""
    if mode == "linear":
        inner = f"""SELECT image_id, {off} AS off, {size} AS sz, d,
                   (2 * d + 1) * {size} - {dst} AS num, 2 * {dst} AS den,
                   CAST(floor(CAST((2 * d + 1) * {size} - {dst} AS DOUBLE) / CAST(2 * {dst} AS DOUBLE)) AS BIGINT) AS s0
            FROM {geom}, range(0, 512) t(d) WHERE d < {dst}"""
        a1 = "((num - s0 * den) * 4096 + den) // (2 * den)"
    else:  # area rule, enlarging
        inner = f"""SELECT image_id, {off} AS off, {size} AS sz, d,
                   (d + 1) * {size} - ((d * {size}) // {dst} + 1) * {dst} AS fnum,
                   (d * {size}) // {dst} AS s0
            FROM {geom}, range(0, 512) t(d) WHERE d < {dst}"""
        a1 = "(CASE WHEN fnum <= 0 THEN 0 ELSE fnum % sz END * 4096 + sz) // (2 * sz)"
    return f"""{name} AS (
  SELECT image_id, d, least(greatest(s0, 0), sz - 1) + off AS i0,
         least(greatest(s0 + 1, 0), sz - 1) + off AS i1, 2048 - a1 AS c0, a1 AS c1
  FROM (SELECT *, {a1} AS a1 FROM ({inner})))"""


def resize_sql(name: str, src: str, geom: str, mode: str = "linear") -> str:
    """``geom`` columns: image_id, oy, ox (window origin), ch, cw (window size),
    dh, dw (resized size), py, px (placement), H, W (canvas size).
    Output CTE ``name`` in long form; canvas pixels outside the placed image are 0."""
    p = f"{name}_"
    parts = [
        _coef(p + "yc", geom, "ch", "dh", "oy", mode),
        _coef(p + "xc", geom, "cw", "dw", "ox", mode),
        f"""{p}hp AS (
  SELECT s0.image_id, s0.y AS sy, xc.d AS x,
         s0.r * xc.c0 + s1.r * xc.c1 AS r, s0.g * xc.c0 + s1.g * xc.c1 AS g, s0.b * xc.c0 + s1.b * xc.c1 AS b
  FROM {p}xc xc JOIN {src} s0 ON s0.image_id = xc.image_id AND s0.x = xc.i0
  JOIN {src} s1 ON s1.image_id = xc.image_id AND s1.x = xc.i1 AND s1.y = s0.y)""",
        f"""{p}vp AS (
  SELECT yc.image_id, yc.d AS y, h0.x,
         (h0.r * yc.c0 + h1.r * yc.c1 + 2097152) >> 22 AS r,
         (h0.g * yc.c0 + h1.g * yc.c1 + 2097152) >> 22 AS g,
         (h0.b * yc.c0 + h1.b * yc.c1 + 2097152) >> 22 AS b
  FROM {p}yc yc JOIN {p}hp h0 ON h0.image_id = yc.image_id AND h0.sy = yc.i0
  JOIN {p}hp h1 ON h1.image_id = yc.image_id AND h1.sy = yc.i1 AND h1.x = h0.x)""",
        f"""{name} AS (
  SELECT g.image_id, g.H AS h, g.W AS w, ty.y, tx.x,
         coalesce(v.r, 0) AS r, coalesce(v.g, 0) AS g, coalesce(v.b, 0) AS b
  FROM {geom} g JOIN range(0, 512) ty(y) ON ty.y < g.H JOIN range(0, 512) tx(x) ON tx.x < g.W
  LEFT JOIN {p}vp v ON v.image_id = g.image_id AND v.y = ty.y - g.py AND v.x = tx.x - g.px)""",
    ]
    return ",\n".join(parts)


def resize_area_down_sql(name: str, src: str, geom: str) -> str:
    p = f"{name}_"
    def w(tag, size, dst, off):
        return f"""{p}{tag} AS (
  SELECT image_id, d, s + {off} AS i,
         greatest(0, least((s + 1) * {dst}, (d + 1) * {size}) - greatest(s * {dst}, d * {size})) AS wt
  FROM {geom}, range(0, 512) t(d), range(0, 4096) u(s) WHERE d < {dst} AND s < {size})"""
    return ",\n".join([
        w("wy", "ch", "dh", "oy"), w("wx", "cw", "dw", "ox"),
        f"""{name} AS (
  SELECT g.image_id, g.dh AS h, g.dw AS w, wy.d AS y, wx.d AS x,
         (2 * sum(wy.wt * wx.wt * s.r) + g.ch * g.cw) // (2 * g.ch * g.cw) AS r,
         (2 * sum(wy.wt * wx.wt * s.g) + g.ch * g.cw) // (2 * g.ch * g.cw) AS g,
         (2 * sum(wy.wt * wx.wt * s.b) + g.ch * g.cw) // (2 * g.ch * g.cw) AS b
  FROM {geom} g JOIN {p}wy wy ON wy.image_id = g.image_id AND wy.wt > 0
  JOIN {src} s ON s.image_id = g.image_id AND s.y = wy.i
  JOIN {p}wx wx ON wx.image_id = g.image_id AND wx.i = s.x AND wx.wt > 0
  GROUP BY g.image_id, g.dh, g.dw, wy.d, wx.d, g.ch, g.cw)"""])


def _geom(name: str, src: str, select: str) -> str:
    return f"{name} AS (SELECT {select} FROM (SELECT DISTINCT image_id, h, w FROM {src}))"


def zoom_sql(name: str, src: str, factor: float) -> str:
    if factor > 1:
        geom = _geom(f"{name}_g", src,
                     f"image_id, CAST(floor(h / {_d(factor)}) AS BIGINT) AS ch, "
                     f"CAST(floor(w / {_d(factor)}) AS BIGINT) AS cw, "
                     f"(h - CAST(floor(h / {_d(factor)}) AS BIGINT)) // 2 AS oy, "
                     f"(w - CAST(floor(w / {_d(factor)}) AS BIGINT)) // 2 AS ox, "
                     "h AS dh, w AS dw, 0 AS py, 0 AS px, h AS H, w AS W")
    else:
        geom = _geom(f"{name}_g", src,
                     f"image_id, h AS ch, w AS cw, 0 AS oy, 0 AS ox, "
                     f"CAST(floor(h * {_d(factor)}) AS BIGINT) AS dh, "
                     f"CAST(floor(w * {_d(factor)}) AS BIGINT) AS dw, "
                     f"(h - CAST(floor(h * {_d(factor)}) AS BIGINT)) // 2 AS py, "
                     f"(w - CAST(floor(w * {_d(factor)}) AS BIGINT)) // 2 AS px, h AS H, w AS W")
    return geom + ",\n" + resize_sql(name, src, f"{name}_g")


def variant_sql(name: str, src: str, suffix: str) -> str:
    table = {
        "_rot90": lambda: rot_sql(name, src, 90), "_rot180": lambda: rot_sql(name, src, 180),
        "_rot270": lambda: rot_sql(name, src, 270), "_bright": lambda: bright_sql(name, src, 1.3),
        "_dark": lambda: bright_sql(name, src, 0.7), "_hflip": lambda: flip_sql(name, src, 1),
        "_vflip": lambda: flip_sql(name, src, 0), "_zoomin": lambda: zoom_sql(name, src, 1.2),
        "_zoomout": lambda: zoom_sql(name, src, 0.8),
    }
    return table[suffix]()


def _px_query(key: str, ctes: list[str], out: str, keys: str = "image_id") -> None:
    register(key, digest_sql(out, keys), ",\n".join(ctes))


register("scan_image_pixels", """
SELECT image_id,
       CASE WHEN k % 50 = 13 THEN NULL ELSE height END AS height,
       CASE WHEN k % 50 = 13 THEN NULL ELSE width END AS width,
       CASE WHEN k % 50 = 13 THEN NULL ELSE sum_r END AS sum_r,
       CASE WHEN k % 50 = 13 THEN NULL ELSE sum_g END AS sum_g,
       CASE WHEN k % 50 = 13 THEN NULL ELSE sum_b END AS sum_b,
       CASE WHEN k % 50 = 13 THEN NULL ELSE chk_r END AS chk_r,
       CASE WHEN k % 50 = 13 THEN NULL ELSE chk_g END AS chk_g,
       CASE WHEN k % 50 = 13 THEN NULL ELSE chk_b END AS chk_b
FROM (SELECT *, CAST(regexp_extract(image_id, '(\\d+)$', 1) AS BIGINT) AS k FROM (""" +
         digest_sql("px_grey") + """))
WHERE k % 50 <> 29""", PX_RECT + """,
px_grey AS (
  SELECT image_id, h, w, y, x, CASE WHEN grey THEN b ELSE r END AS r, CASE WHEN grey THEN b ELSE g END AS g, b
  FROM (SELECT *, CAST(regexp_extract(image_id, '(\\d+)$', 1) AS BIGINT) % 50 = 17 AS grey FROM px_rect))""")
_px_query("img_rotate_90", [PX_RECT, rot_sql("o", "px_rect", 90)], "o")
_px_query("img_rotate_180", [PX_RECT, rot_sql("o", "px_rect", 180)], "o")
_px_query("img_rotate_270", [PX_RECT, rot_sql("o", "px_rect", 270)], "o")
_px_query("img_hflip", [PX_RECT, flip_sql("o", "px_rect", 1)], "o")
_px_query("img_vflip", [PX_RECT, flip_sql("o", "px_rect", 0)], "o")
_px_query("img_bright", [PX_RECT, bright_sql("o", "px_rect", 1.3)], "o")
_px_query("img_dark", [PX_RECT, bright_sql("o", "px_rect", 0.7)], "o")
_px_query("img_zoom_in", [PX_RECT, zoom_sql("o", "px_rect", 1.2)], "o")
_px_query("img_zoom_out", [PX_RECT, zoom_sql("o", "px_rect", 0.8)], "o")
_px_query("img_bgr_rgb", [PX_RECT, "o AS (SELECT image_id, h, w, y, x, b AS r, g, r AS b FROM px_rect)"],
          "o")
_px_query("img_center_square", [PX_RECT, index_map(
    "o", "px_rect", "least(sh, sw)", "least(sh, sw)", "sy - (sh - least(sh, sw)) // 2",
    "sx - (sw - least(sh, sw)) // 2",
    "sy >= (sh - least(sh, sw)) // 2 AND sy < (sh - least(sh, sw)) // 2 + least(sh, sw) "
    "AND sx >= (sw - least(sh, sw)) // 2 AND sx < (sw - least(sh, sw)) // 2 + least(sh, sw)")], "o")
_px_query("img_resize_area", [PX_RECT, _geom(
    "g", "px_rect", "image_id, 0 AS oy, 0 AS ox, h AS ch, w AS cw, 128 AS dh, 128 AS dw, "
    "0 AS py, 0 AS px, 128 AS H, 128 AS W"), resize_sql("o", "px_rect", "g", mode="area")], "o")
_px_query("img_resize_area_down", [PX_RECT, _geom(
    "g", "px_rect", "image_id, 0 AS oy, 0 AS ox, h AS ch, w AS cw, 12 AS dh, 20 AS dw"),
    resize_area_down_sql("o", "px_rect", "g")], "o")
_BORDER = (f"CAST(floor(sh * {_d(0.03)}) AS BIGINT)", f"CAST(floor(sw * {_d(0.03)}) AS BIGINT)")
_px_query("img_border_crop", [PX_SYNTH, index_map(
    "o", "px_synth", f"sh - 2 * {_BORDER[0]}", f"sw - 2 * {_BORDER[1]}", f"sy - {_BORDER[0]}",
    f"sx - {_BORDER[1]}",
    f"sy >= {_BORDER[0]} AND sy < sh - {_BORDER[0]} AND sx >= {_BORDER[1]} AND sx < sw - {_BORDER[1]}")],
    "o")

_variant_ctes = [PX_RECT]
_variant_union = []
for _name, _suffix, _ in VARIANTS:
    _cte = "o" + _suffix.strip("_")
    _variant_ctes.append(variant_sql(_cte, "px_rect", _suffix))
    _variant_union.append(f"SELECT image_id, '{_suffix}' AS variant, h, w, y, x, r, g, b FROM {_cte}")
_variant_ctes.append("o_all AS (" + "\nUNION ALL ".join(_variant_union) + ")")
_px_query("augment_variants", _variant_ctes, "o_all", keys="image_id, variant")
_px_query("write_image_table", _variant_ctes, "o_all", keys="image_id, variant")
register("augment_status", """
SELECT concat('IMG_', CAST(e.vec_id AS VARCHAR)) AS image_id, v.variant, e.vec_id % 50 <> 13 AS ok
FROM embeddings e, v_variants v""")


# ----- planes: pigment score, Otsu, closing, components, blur, attenuation

def _lin(c: str) -> str:
    v = f"(CAST({c} AS DOUBLE) / {_d(255.0)})"
    return (f"CASE WHEN {v} <= {_d(0.04045)} THEN {v} / {_d(12.92)} "
            f"ELSE pow(({v} + {_d(0.055)}) / {_d(1.055)}, {_d(2.4)}) END")


def _labf(t: str) -> str:
    return (f"CASE WHEN {t} > {_d(0.008856)} THEN cbrt({t}) "
            f"ELSE {_d(7.787)} * {t} + {_d(16.0)} / {_d(116.0)} END")


def score_sql(name: str, src: str) -> str:
    """Pigment score plane (image_id, h, w, y, x, v) of an RGB long table."""
    return f"""{name}_lin AS (
  SELECT *, {_lin('r')} AS lr, {_lin('g')} AS lg, {_lin('b')} AS lb,
         greatest(r, g, b) AS vv, greatest(r, g, b) - least(r, g, b) AS diff FROM {src}),
{name}_xyz AS (
  SELECT *, ({_d(0.412453)} * lr + {_d(0.357580)} * lg + {_d(0.180423)} * lb) / {_d(0.950456)} AS cx,
            {_d(0.212671)} * lr + {_d(0.715160)} * lg + {_d(0.072169)} * lb AS cy,
            ({_d(0.019334)} * lr + {_d(0.119193)} * lg + {_d(0.950227)} * lb) / {_d(1.088754)} AS cz
  FROM {name}_lin),
{name}_ab AS (
  SELECT *, CAST(least({_d(255.0)}, greatest({_d(0.0)},
              floor({_d(500.0)} * ({_labf('cx')} - {_labf('cy')}) + {_d(128.0)} + {_d(0.5)}))) AS BIGINT) AS a8,
            CAST(least({_d(255.0)}, greatest({_d(0.0)},
              floor({_d(200.0)} * ({_labf('cy')} - {_labf('cz')}) + {_d(128.0)} + {_d(0.5)}))) AS BIGINT) AS b8,
            CASE WHEN vv = 0 THEN 0 ELSE (510 * diff + vv) // (2 * vv) END AS ss
  FROM {name}_xyz),
{name} AS (
  SELECT image_id, h, w, y, x, least(255, greatest(0, (6 * (255 - vv) + 3 * ss + a8 + b8) // 10)) AS v
  FROM {name}_ab)"""


def otsu_sql(name: str, plane: str) -> str:
    """(image_id, threshold) of a plane (image_id, h, w, y, x, v)."""
    return f"""{name}_h AS (SELECT image_id, v, count(*) AS c FROM {plane} GROUP BY image_id, v),
{name}_c AS (
  SELECT image_id, v,
         sum(c) OVER (PARTITION BY image_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n1,
         sum(c * v) OVER (PARTITION BY image_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s1,
         sum(c) OVER (PARTITION BY image_id) AS n, sum(c * v) OVER (PARTITION BY image_id) AS st
  FROM {name}_h),
{name}_s AS (
  SELECT image_id, v, CAST(n * s1 - n1 * st AS DOUBLE) * CAST(n * s1 - n1 * st AS DOUBLE)
                      / CAST(n1 * (n - n1) AS DOUBLE) AS sigma
  FROM {name}_c WHERE n1 > 0 AND n - n1 > 0),
{name} AS (
  SELECT i.image_id, CAST(coalesce(b.v, 0) AS INTEGER) AS threshold
  FROM (SELECT DISTINCT image_id FROM {plane}) i
  LEFT JOIN (SELECT image_id, v FROM (
      SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY sigma DESC, v ASC) AS rn FROM {name}_s)
    WHERE rn = 1) b ON b.image_id = i.image_id)"""


def close_sql(name: str, plane: str, thr: str, radius: int) -> str:
    """Binary mask (v > threshold) closed by a (2r+1) square, as m in {{0, 1}}."""
    win = f"ROWS BETWEEN {radius} PRECEDING AND {radius} FOLLOWING"
    return f"""{name}_m AS (
  SELECT p.image_id, p.h, p.w, p.y, p.x, CASE WHEN p.v > t.threshold THEN 1 ELSE 0 END AS m
  FROM {plane} p JOIN {thr} t ON t.image_id = p.image_id),
{name}_d1 AS (SELECT image_id, h, w, y, x, max(m) OVER (PARTITION BY image_id, y ORDER BY x {win}) AS m
  FROM {name}_m),
{name}_d2 AS (SELECT image_id, h, w, y, x, max(m) OVER (PARTITION BY image_id, x ORDER BY y {win}) AS m
  FROM {name}_d1),
{name}_e1 AS (SELECT image_id, h, w, y, x, min(m) OVER (PARTITION BY image_id, y ORDER BY x {win}) AS m
  FROM {name}_d2),
{name} AS (SELECT image_id, h, w, y, x, min(m) OVER (PARTITION BY image_id, x ORDER BY y {win}) AS m
  FROM {name}_e1)"""


def _refl(i: str, n: str) -> str:
    p = f"(2 * {n} - 2)"
    a = f"(abs({i}) % {p})"
    return f"CASE WHEN {n} = 1 THEN 0 WHEN {a} >= {n} THEN {p} - {a} ELSE {a} END"


def blur_sql(name: str, mask: str) -> str:
    """21-tap integer Gaussian of 255*m with mirrored edges -> (.., v).

    Each pass pads a line by 10 mirrored samples on both sides (a join on the
    reflected index) and sums the 21 weighted ``lead`` values of a window.
    """
    w = [int(x) for x in gaussian_weights()]
    r = len(w) // 2

    def taps(col: str, win: str) -> str:
        return " + ".join(f"{wt} * {col}" if k == 0 else f"{wt} * lead({col}, {k}) OVER {win}"
                          for k, wt in enumerate(w))

    return f"""{name}_hpad AS (
  SELECT c.image_id, c.h, c.w, c.y, q.q, CAST(255 * s.m AS BIGINT) AS pm
  FROM (SELECT DISTINCT image_id, h, w, y FROM {mask}) c
  JOIN range(-{r}, 512) q(q) ON q.q < c.w + {r}
  JOIN {mask} s ON s.image_id = c.image_id AND s.y = c.y AND s.x = {_refl('q.q', 'c.w')}),
{name}_h AS (
  SELECT image_id, h, w, y, q + {r} AS x, hv FROM (
    SELECT image_id, h, w, y, q, {taps('pm', 'wh')} AS hv
    FROM {name}_hpad WINDOW wh AS (PARTITION BY image_id, y ORDER BY q))
  WHERE q + {r} >= 0 AND q + {r} < w),
{name}_vpad AS (
  SELECT c.image_id, c.h, c.w, c.x, q.q, CAST(s.hv AS BIGINT) AS ph
  FROM (SELECT DISTINCT image_id, h, w, x FROM {name}_h) c
  JOIN range(-{r}, 512) q(q) ON q.q < c.h + {r}
  JOIN {name}_h s ON s.image_id = c.image_id AND s.x = c.x AND s.y = {_refl('q.q', 'c.h')}),
{name} AS (
  SELECT image_id, h, w, q + {r} AS y, x, (vv + 2147483648) >> 32 AS v FROM (
    SELECT image_id, h, w, x, q, {taps('ph', 'wv')} AS vv
    FROM {name}_vpad WINDOW wv AS (PARTITION BY image_id, x ORDER BY q))
  WHERE q + {r} >= 0 AND q + {r} < h)"""


def attenuate_sql(name: str, rgb: str) -> str:
    """Background attenuation of an RGB long table."""
    return ",\n".join([
        score_sql(f"{name}_sc", rgb), otsu_sql(f"{name}_ot", f"{name}_sc"),
        close_sql(f"{name}_cl", f"{name}_sc", f"{name}_ot", 8), blur_sql(f"{name}_bl", f"{name}_cl"),
        f"""{name} AS (
  SELECT p.image_id, p.h, p.w, p.y, p.x, (p.r * (765 + 2 * m.v)) // 1275 AS r,
         (p.g * (765 + 2 * m.v)) // 1275 AS g, (p.b * (765 + 2 * m.v)) // 1275 AS b
  FROM {rgb} p JOIN {name}_bl m ON m.image_id = p.image_id AND m.y = p.y AND m.x = p.x)"""])


def _grey_out(name: str, plane: str, expr: str = "v") -> str:
    return f"{name} AS (SELECT image_id, h, w, y, x, {expr} AS r, {expr} AS g, {expr} AS b FROM {plane})"


_px_query("img_pigment_score", [PX_SYNTH, score_sql("sc", "px_synth"), _grey_out("o", "sc")], "o")
register("img_otsu_threshold", "SELECT image_id, threshold FROM ot",
         ",\n".join([PX_SYNTH, score_sql("sc", "px_synth"), otsu_sql("ot", "sc")]))
_px_query("img_morph_close", [PX_SYNTH, score_sql("sc", "px_synth"), otsu_sql("ot", "sc"),
                              close_sql("cl", "sc", "ot", 6), _grey_out("o", "cl", "255 * m")], "o")
_px_query("img_gaussian_blur", [PX_SYNTH, score_sql("sc", "px_synth"), otsu_sql("ot", "sc"),
                                close_sql("cl", "sc", "ot", 8), blur_sql("bl", "cl"),
                                _grey_out("o", "bl")], "o")
_px_query("img_attenuate_bg", [PX_SYNTH, attenuate_sql("o", "px_synth")], "o")

# border crop -> lesion mask -> single component box (every synthetic image has
# exactly one lesion component, checked at sf 0.001 to 0.1)
_CROP = index_map(
    "cr", "px_synth", f"sh - 2 * {_BORDER[0]}", f"sw - 2 * {_BORDER[1]}", f"sy - {_BORDER[0]}",
    f"sx - {_BORDER[1]}",
    f"sy >= {_BORDER[0]} AND sy < sh - {_BORDER[0]} AND sx >= {_BORDER[1]} AND sx < sw - {_BORDER[1]}")
_ROI = ",\n".join([PX_SYNTH, _CROP, score_sql("sc", "cr"), otsu_sql("ot", "sc"), close_sql("cl", "sc", "ot", 6),
                   """bx AS (
  SELECT image_id, any_value(h) AS h, any_value(w) AS w, count(*) AS area, min(x) AS x, min(y) AS y,
         max(x) - min(x) + 1 AS bw, max(y) - min(y) + 1 AS bh
  FROM cl WHERE m = 1 GROUP BY image_id)""",
                   f"""roi AS (
  SELECT image_id, h, w,
         greatest(0, x - CAST(floor(bw * {_d(0.15)}) AS BIGINT)) AS x0,
         greatest(0, y - CAST(floor(bh * {_d(0.15)}) AS BIGINT)) AS y0,
         least(w, x + bw + CAST(floor(bw * {_d(0.15)}) AS BIGINT)) AS x1,
         least(h, y + bh + CAST(floor(bh * {_d(0.15)}) AS BIGINT)) AS y1
  FROM bx)"""])
register("largest_component", """
SELECT b.image_id, CAST(q.q4 AS DOUBLE) + CAST(q.q3 AS DOUBLE) / 2.0::DOUBLE AS area,
       CAST(b.x AS INTEGER) AS x, CAST(b.y AS INTEGER) AS y, CAST(b.bw AS INTEGER) AS bw,
       CAST(b.bh AS INTEGER) AS bh, CAST(b.area AS INTEGER) AS n_pixels
FROM bx b JOIN (
  SELECT image_id, count(*) FILTER (WHERE s = 4) AS q4, count(*) FILTER (WHERE s = 3) AS q3
  FROM (SELECT image_id, m + mr + md + mdr AS s FROM (
          SELECT image_id, m, md,
                 lead(m) OVER (PARTITION BY image_id, y ORDER BY x) AS mr,
                 lead(md) OVER (PARTITION BY image_id, y ORDER BY x) AS mdr
          FROM (SELECT image_id, y, x, m,
                       lead(m) OVER (PARTITION BY image_id, x ORDER BY y) AS md FROM cl))
        WHERE mr IS NOT NULL AND md IS NOT NULL)
  GROUP BY image_id) q ON q.image_id = b.image_id""", _ROI)
register("img_roi_box", """
SELECT image_id, CAST(x0 AS INTEGER) AS x0, CAST(y0 AS INTEGER) AS y0, CAST(x1 AS INTEGER) AS x1,
       CAST(y1 AS INTEGER) AS y1 FROM roi""", _ROI)
_px_query("preprocess_image", [
    _ROI,
    """pg AS (SELECT image_id, y0 AS oy, x0 AS ox, y1 - y0 AS ch, x1 - x0 AS cw, 128 AS dh, 128 AS dw,
                 0 AS py, 0 AS px, 128 AS H, 128 AS W FROM roi)""",
    resize_sql("rs", "cr", "pg", mode="area"),
    attenuate_sql("o", "rs")], "o")

"""SQL for the queries that it can express: written from the statement of the problem, not from the operator."""

from __future__ import annotations

from spoolwright.llm.consistent import consistent_sql

_SLASHED = r"regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace({p}, '^\s+|\s+$', '', 'g')), '[\\/]+(?:\.[\\/]+)*', '/', 'g'), '^\./', ''), '/\.?$', '')"


def _file(path: str) -> str:
    roots = f"(SELECT string_agg(regexp_escape({_SLASHED.format(p='root_path')}), '|' ORDER BY length(root_path) DESC) FROM path_roots)"
    return f"regexp_replace({_SLASHED.format(p=path)}, '^(?:' || {roots} || ')(/|$)', (SELECT min(canonical_root) FROM path_roots) || '\\1')"


_BARE = r"regexp_replace({k}, '\.[a-z][a-z0-9]{{1,4}}$', '')"

_MIXED = rf"""WITH RECURSIVE m AS (SELECT row_id, uid, split_name, coalesce(aug_stage, '') AS stage, nullif(trim(base_uid), '') AS base_uid, {_file("audio_path")} AS a, {_BARE.format(k=_file("source_audio"))} AS src, round(start_sec * 1000) AS s, round(end_sec * 1000) AS e FROM manifest_rows),
b AS (SELECT {_file("batch_file")} AS batch, {_BARE.format(k=_file("original_file"))} AS rec, round(start_sec * 1000) AS bs, round(end_sec * 1000) AS be FROM batch_map WHERE end_sec > start_sec AND original_file IS NOT NULL),
d AS (SELECT *, coalesce(nullif(src, ''), CASE WHEN regexp_matches(a, '(^|/)chunks/[^/]+/.+__chunk\d+(__[^/]*)?(\.[^./]*)?$') THEN regexp_replace(a, '(^|/)chunks/([^/]+)/(.+)__chunk\d+(?:__[^/]*?)?(?:\.[^./]*)?$', '\1recordings/\2/\3') END,
    (SELECT min(rec) FROM b WHERE batch = a AND bs <= s AND e <= be)) AS rec FROM m),
n AS (SELECT *, CASE WHEN rec IS NULL AND (stage <> '' OR contains(a, '/aug/') OR base_uid <> uid) THEN coalesce(base_uid, nullif(regexp_extract(a, '(?:^|/)aug/([^/_]+)_[^/_]+__[^/]*$', 1), '')) END AS up FROM d),
w(row_id, split_name, rec, up, step) AS (SELECT row_id, split_name, rec, up, 0 FROM n
    UNION ALL SELECT w.row_id, w.split_name, p.rec, p.up, step + 1 FROM w JOIN (SELECT DISTINCT uid, rec, up FROM n WHERE rec IS NOT NULL OR up IS NOT NULL) p ON p.uid = w.up WHERE w.rec IS NULL AND step < 20),
r AS (SELECT DISTINCT row_id, split_name, rec FROM w WHERE rec IS NOT NULL)
SELECT row_id FROM r WHERE rec IN (SELECT rec FROM r GROUP BY rec HAVING count(DISTINCT split_name) > 1)"""

_FORMS = r"[\x{FF01}-\x{FF9F}\x{FFE0}-\x{FFEE}\x{FB00}-\x{FB06}\x{FE50}-\x{FE6B}]"
_HIDDEN = r"[\x{AD}\x{34F}\x{61C}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}]"
_SPACES = r"[\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]"
_FOREIGN = r"\p{Latin}\p{M}*(?:\p{Cyrillic}|\p{Greek}|\p{Armenian})|(?:\p{Cyrillic}|\p{Greek}|\p{Armenian})\p{M}*\p{Latin}|[ɑɡ]"
_CASE = f"regexp_matches(text, '{_FORMS}') OR regexp_matches(text, '{_HIDDEN}') OR regexp_matches(text, '{_SPACES}') OR nfc_normalize(text) <> text OR regexp_matches(text, '{_FOREIGN}')"
_CHANGED = f"SELECT 'segment_refs' AS tbl, seg_key AS row_key FROM segment_refs WHERE {_CASE} UNION ALL SELECT 'manifest_rows', row_id FROM manifest_rows WHERE {_CASE}"

_US = "CAST(round({c} * 1000000) AS BIGINT)"
_KINDS = f"""WITH t AS (SELECT task_id, {_file("audio_path")} AS file, {_US.format(c="core_start")} AS s, {_US.format(c="core_end")} AS e, {_US.format(c="target_out_sec")} AS l, {_US.format(c="overlap_sec")} AS o FROM cut_tasks
    WHERE core_start IS NOT NULL AND core_end > core_start AND target_out_sec > 0 AND NOT isnan(target_out_sec) AND core_end - core_start > target_out_sec + 0.001),
r AS (SELECT DISTINCT {_file("audio_path")} AS file, {_US.format(c="end_sec")} AS x FROM segment_refs WHERE NOT isnan(end_sec) AND end_sec > start_sec),
i AS (SELECT task_id, x FROM t JOIN r USING (file) WHERE x > s AND x < e UNION ALL SELECT task_id, e FROM t),
f AS (SELECT task_id, max(x) AS f FROM i JOIN t USING (task_id) WHERE x <= s + l GROUP BY task_id),
g AS (SELECT task_id, max(gap) AS gap FROM (SELECT task_id, lead(x) OVER (PARTITION BY task_id ORDER BY x) - x AS gap FROM i JOIN f USING (task_id) WHERE x >= f) GROUP BY task_id)
SELECT task_id, CASE WHEN gap <= l - coalesce(o, 0) THEN 'natural' ELSE 'forced' END AS cut_kind FROM t LEFT JOIN g USING (task_id)"""

# the consistent form is that of the operator (p4_found checks it by another rule); the words, the edits and the paths are said anew
_PAIRS = rf"""WITH m AS MATERIALIZED (SELECT row_id, split_name = 'train' AS train, text, {_file("audio_path")} AS f, start_sec, end_sec FROM manifest_rows WHERE split_name IN ('train', 'validation', 'test') AND row_id IS NOT NULL),
l AS MATERIALIZED (SELECT row_id, train, list_filter(regexp_extract_all(regexp_replace(lower(z), '[''’]', '', 'g'), '[\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS l FROM ({consistent_sql("(SELECT row_id, train, text FROM m WHERE text IS NOT NULL)", "text", "z")})),
c AS MATERIALIZED (SELECT row_number() OVER () AS c, train, l, len(l) AS n FROM (SELECT DISTINCT train, l FROM l WHERE len(l) >= 8)),
w AS MATERIALIZED (SELECT c, train, n, w, row_number() OVER (PARTITION BY c, w) AS i FROM (SELECT c, train, n, unnest(l) AS w FROM c)),
k AS (SELECT e.c AS e, t.c AS t FROM w e JOIN w t ON e.w = t.w AND e.i = t.i AND NOT e.train AND t.train GROUP BY 1, 2 HAVING 20 * (any_value(greatest(e.n, t.n)) - count(*)) <= 3 * any_value(greatest(e.n, t.n))),
d AS (SELECT e, t, x.l AS a, y.l AS b, list_distinct(list_concat(x.l, y.l)) AS d FROM k JOIN c x ON x.c = e JOIN c y ON y.c = t),
h AS (SELECT e, t FROM d WHERE 20 * levenshtein(array_to_string(list_transform(a, lambda w: chr(list_position(d, w)::INT)), ''), array_to_string(list_transform(b, lambda w: chr(list_position(d, w)::INT)), '')) <= 3 * greatest(len(a), len(b))),
p AS (SELECT a.row_id AS x, b.row_id AS y FROM h JOIN c e ON e.c = h.e JOIN c t ON t.c = h.t JOIN l a ON a.l = e.l AND NOT a.train JOIN l b ON b.l = t.l AND b.train
    UNION SELECT a.row_id, b.row_id FROM m a JOIN m b ON a.f = b.f AND NOT a.train AND b.train AND a.start_sec IS NOT DISTINCT FROM b.start_sec AND a.end_sec IS NOT DISTINCT FROM b.end_sec)
SELECT least(x, y) AS row_id_a, greatest(x, y) AS row_id_b FROM p"""

_TEXTS = " UNION ALL ".join(
    f"(SELECT '{t}' AS tbl, row_key, consistent, coalesce(consistent <> text, false) AS changed FROM ({consistent_sql(f'(SELECT {key} AS row_key, text FROM {t})', 'text', 'consistent')}))" for t, key in (("segment_refs", "seg_key"), ("manifest_rows", "row_id"))
)

ORACLES = {"p1_found": _PAIRS, "p4_texts": _TEXTS, "p3_found": _MIXED, "p4_found": _CHANGED, "p5_found": _KINDS}

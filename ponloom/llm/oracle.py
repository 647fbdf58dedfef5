"""DuckDB SQL for the operators on conversations and importance, next to the queries of ``queries.py``."""

from __future__ import annotations

# CRC-32 by the bits of its polynomial: a table of 256 sums, then a fold over the bytes of a text.
_CRC = """
        crc AS (SELECT list(c ORDER BY i) AS tab FROM (
            SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM (SELECT unnest(range(0, 256)) AS i)))"""


def _sum_of(text: str) -> str:
    octets = f"list_transform(range(0, length(hex(encode({text}))) // 2), lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))"
    return f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}),
                lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295)"""


_SPACE = r"[\x20\x09-\x0D]"
_NONE = "{'c': 1000000, 't': '', 'r': ''}"


def _add(state: str, cost: str, letter: str, role: str, text: str) -> str:
    """A state after one more edit; a turn that stays is added to the repaired text."""
    turn = "''" if role == "" else f"CASE WHEN {state}.t = '' OR replace({state}.t, 'D', '') = '' THEN '' ELSE chr(10) END || {role} || ':' || {text}"
    return f"{{'c': {state}.c + {cost}, 't': {state}.t || '{letter}', 'r': {state}.r || {turn}}}"


def _least(*states: str) -> str:
    return f"list_sort([{', '.join(states)}])[1]"


def _edits() -> dict[str, str]:
    user = [_add(s, "5", "I", "'user'", "''") for s in ("e", "s", "a")]
    gone = {x: _add(x, "2", "D", "", "") for x in ("e", "s", "u1", "a1")}
    stay = {
        "s": [("e", "s")],
        "u": [("e", "u"), ("s", "u"), ("a1", "u")],
        "a": [("u1", "a")],
    }
    names = {"s": "''", "u": "'user'", "a": "'assistant'"}
    new = {}
    for state, before in (("e", "e"), ("s", "s"), ("u", "u1"), ("a", "a1")):
        options = [gone[before]]
        for old, initial in stay.get(state, []):
            options.append(f"CASE WHEN NOT must_go AND initial = '{initial}' THEN {_add(old, 'extra', 'K', 'role', 'text')} ELSE {_NONE} END")
            if state != "s":
                options.append(f"CASE WHEN NOT must_go AND initial <> '{initial}' THEN {_add(old, '1 + extra', 'R', names[state], 'text')} ELSE {_NONE} END")
        new[state] = _least(*options)
    return {"u1": _least("u", *user), "a1": _least("a", _add("u1", "5", "I", "'assistant'", "''")), **{f"{k}_new": v for k, v in new.items()}}


_E = _edits()

TURN_REPAIR = f"""
        WITH RECURSIVE {_CRC},
        kinds AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                {_sum_of("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
            FROM conversations, crc),
        damaged AS (
            SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM kinds, unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS x(n)),
        placed AS (
            SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
                regexp_replace(text, '{_SPACE}+$', '') AS ended
            FROM damaged),
        seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again FROM placed),
        faults AS (
            SELECT *, ended = '' AS blank, ended <> '' AND again AS duplicate, ended <> '' AND NOT again AND right(ended, 1) NOT IN ('.', '!', '?') AS truncated,
                coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
            FROM seen),
        turns AS (SELECT *, blank OR duplicate AS must_go, CASE WHEN truncated THEN 5 ELSE 0 END AS extra FROM faults),
        begun AS (SELECT DISTINCT conv_id FROM turns),
        steps AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS n, {{'c': 0, 't': '', 'r': ''}} AS e, {_NONE} AS s, {_NONE} AS u, {_NONE} AS a FROM begun
            UNION ALL
            SELECT conv_id, n, {_E['e_new']}, {_E['s_new']}, {_E['u_new']}, {_E['a_new']}
            FROM (SELECT *, {_E['a1']} AS a1 FROM (
                SELECT t.conv_id, t.n, t.role, t.text, t.initial, t.must_go, t.extra, e, s, u, a, {_E['u1']} AS u1
                FROM steps JOIN turns AS t ON t.conv_id IS NOT DISTINCT FROM steps.conv_id AND t.n = steps.n + 1))),
        last AS (
            SELECT conv_id, {_least('e', _E['a1'])} AS best
            FROM (SELECT conv_id, e, a, {_E['u1']} AS u1 FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1)),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
                count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(illegal) AS illegal
            FROM turns GROUP BY conv_id),
        found AS (SELECT counts.*, best FROM counts JOIN last ON counts.conv_id IS NOT DISTINCT FROM last.conv_id)
        SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
            CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
            CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.t, '') AS audit,
            sha256(coalesce(best.r, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN found ON o.conv_id IS NOT DISTINCT FROM found.conv_id"""


def importance(words: str) -> str:
    """``words`` is the SQL that cuts a text into words."""
    def runs(table: str, key: str) -> str:
        return f"""SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS f
            FROM (SELECT {key} AS id, {words} AS w FROM {table})"""

    return f"""
        WITH {_CRC},
        d AS (SELECT f, row AS id, count(*) AS n FROM ({runs('(SELECT *, row_number() OVER () AS r FROM documents)', 'r')}) AS x(row, f) GROUP BY f, row),
        b AS (SELECT f, count(*) AS n FROM ({runs('benchmark', 'item_id')}) GROUP BY f),
        names AS (SELECT f, {_sum_of('f')} % 10000 AS bucket FROM (SELECT f FROM d UNION SELECT f FROM b), crc),
        corpus AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM d JOIN names USING (f) GROUP BY bucket),
        target AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS t FROM b JOIN names USING (f) GROUP BY bucket),
        sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus) AS all_s, (SELECT coalesce(sum(t), 0) FROM target) AS all_t),
        gain AS (
            SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + 10000) AS DOUBLE)
                / CAST((coalesce(s, 0) + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
            FROM corpus LEFT JOIN target USING (bucket), sums),
        weights AS (
            SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
            FROM d JOIN names USING (f) JOIN gain USING (bucket) GROUP BY id),
        scored AS (
            SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(
                -1000 * ln(-ln((CAST('0x' || left(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
            FROM (SELECT doc_id, {words} AS w, r FROM (SELECT *, row_number() OVER () AS r FROM documents)) LEFT JOIN weights ON weights.id = r),
        places AS (SELECT doc_id, n_features, weight, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER () AS n
            FROM scored WHERE n_words >= 20)
        SELECT doc_id, n_features, weight, score, rank FROM (
            SELECT s.doc_id, CAST(s.n_features AS BIGINT) AS n_features, CAST(s.weight AS BIGINT) AS weight, CAST(s.score AS BIGINT) AS score,
                CAST(CASE WHEN place <= 25 * n // 100 THEN place END AS BIGINT) AS rank
            FROM scored AS s LEFT JOIN places AS p ON p.doc_id = s.doc_id)"""

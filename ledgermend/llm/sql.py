"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from ledgermend.llm.conversation_repair import Costs
from ledgermend.llm.decontamination import BETWEEN, WIDTH
from ledgermend.llm.quality_rules import HALF_SPREADS, MIN_WORDS, PRIOR_ROWS, QUANTILES, RATES, SIZE_SHARE, SIZES, TAILS, THINGS, TOTALS

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _without(characters: str) -> str:
    return f"length(text) - length(regexp_replace(text, '[{characters}]', '', 'g'))"


def _bucket(value: str) -> str:
    return f"(({value} >> greatest(length(bin({value})) - 6, 0)) << greatest(length(bin({value})) - 6, 0))"


def _placed(rows: str, keys: str) -> str:
    """Buckets (keys, low, n) with the count up to each and the whole one."""
    return f"(SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY low) AS upto, sum(n) OVER (PARTITION BY {keys}) AS total FROM {rows})"


def _prior(rows: str, keys: str) -> str:
    """PRIOR_ROWS texts spread evenly over histograms."""
    upto, before = (f"(2 * {PRIOR_ROWS} * {count} + total) // (2 * total)" for count in ("upto", "(upto - n)"))
    return f"SELECT * FROM (SELECT {keys}, low, {upto} - {before} AS n FROM {_placed(rows, keys)}) WHERE n > 0"


def _quantiles(rows: str, keys: str) -> str:
    chosen = ", ".join(f"min(low) FILTER (upto * {d} >= total * {n}) AS {name}" for name, (n, d) in QUANTILES.items())
    return f"SELECT {keys}, {chosen} FROM {_placed(rows, keys)} GROUP BY {keys}"


def _quality_rules() -> str:
    rates = {name: f"({factor} * {counted}) // greatest({total}, 1)" for name, (factor, counted, total) in RATES.items()}
    sketched = {**{name: name for name in RATES}, **{f"of_{name}": name for name in TOTALS}}
    values = " UNION ALL ".join(f"SELECT lang, source, '{rate}' AS rate, {column} AS v FROM passing" for rate, column in sketched.items())
    of_group = ", ".join(f"max(q2) FILTER (rate = 'of_{name}') AS of_{name}" for name in TOTALS)

    def limit(name: str, side: str) -> str:
        factor, _, total = RATES[name]
        least = f"q2 // {SIZE_SHARE}" if name in SIZES else f"{THINGS * factor} // greatest(of_{total}, 1)"
        beyond = f"greatest({TAILS} * tail_{side}, {least})"
        fence = f"q2 + {HALF_SPREADS} * (q2 - q1) + {beyond}" if side == "max" else f"q2 - {HALF_SPREADS} * (q3 - q2) - {beyond}"
        return f"max({fence}) FILTER (rate = '{name}') AS {name}_{side}"

    found = ", ".join([limit(name, "max") for name in RATES] + [limit(name, "min") for name in SIZES])
    checks = [f"r.{name} <= f.{name}_max" for name in RATES] + [f"r.{name} >= f.{name}_min" for name in SIZES]
    return rf"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
                   {_WORDS.format("coalesce(text, '')")} AS ws,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
            FROM documents
        ),
        words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
        placed AS (
            SELECT *, word = lag(word) OVER o AS again, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS g
            FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ),
        often AS (SELECT doc_id, i FROM (SELECT doc_id, i, g, count(*) OVER (PARTITION BY doc_id, g) AS c FROM placed WHERE g IS NOT NULL) WHERE c > 1),
        covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM often, (VALUES (0), (1), (2)) AS t(k) GROUP BY doc_id),
        doubled AS (SELECT doc_id, count(*) AS n_twice FROM placed WHERE again GROUP BY doc_id),
        counted AS (
            SELECT doc_id, lang, source, text, len(ws) AS n_words,
                   CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   {_without("#*$%&|<>")} AS n_symbols, {_without("A-Z")} AS n_upper,
                   len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_twice, 0) AS n_twice
            FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN doubled USING (doc_id)
        ),
        rates AS (
            SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                   {", ".join(f"{rule} AS {name}" for name, rule in rates.items())}
            FROM counted
        ),
        passing AS (SELECT DISTINCT lang, source, text, {", ".join(RATES)}, {", ".join(TOTALS)} FROM rates WHERE NOT base_failed),
        sketch AS (SELECT lang, source, rate, {_bucket("v")} AS low, count(*) AS n FROM ({values}) GROUP BY ALL),
        overall AS ({_prior("(SELECT rate, low, sum(n) AS n FROM sketch GROUP BY ALL)", "rate")}),
        in_lang AS (
            SELECT lang, rate, low, sum(n) AS n
            FROM (SELECT lang, rate, low, n FROM sketch UNION ALL SELECT l.lang, o.* FROM (SELECT DISTINCT lang FROM sketch) AS l, overall AS o)
            GROUP BY ALL
        ),
        of_lang AS ({_prior("in_lang", "lang, rate")}),
        in_group AS (
            SELECT lang, source, rate, low, n FROM sketch
            UNION ALL SELECT g.lang, g.source, p.rate, p.low, p.n FROM (SELECT DISTINCT lang, source FROM sketch) AS g JOIN of_lang AS p USING (lang)
        ),
        quantiles AS ({_quantiles("in_group", "lang, source, rate")}),
        tails AS (
            SELECT rate, side, {_bucket("tail")} AS low, count(*) AS n
            FROM (SELECT rate, 'max' AS side, q2 - q10 AS tail FROM quantiles UNION ALL SELECT rate, 'min', q90 - q2 FROM quantiles) GROUP BY ALL
        ),
        usual AS (
            SELECT rate, max(q2) FILTER (side = 'max') AS tail_max, max(q2) FILTER (side = 'min') AS tail_min
            FROM ({_quantiles("tails", "rate, side")}) GROUP BY rate
        ),
        sizes AS (SELECT lang, source, {of_group} FROM quantiles GROUP BY ALL),
        found AS (SELECT lang, source, {found} FROM quantiles JOIN usual USING (rate) JOIN sizes USING (lang, source) GROUP BY ALL)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               coalesce(NOT base_failed AND {" AND ".join(checks)}, false) AS kept
        FROM rates AS r LEFT JOIN found AS f USING (lang, source)
    """


def _decontamination() -> str:
    letters = BETWEEN.replace("[", "[^", 1)
    words = f"regexp_extract_all({_LOWER}, '{letters}+')"
    grams = "list_transform(range(1, len({0}) - {1} + 2), lambda i: array_to_string(list_slice({0}, i, i + {1} - 1), ' '))"
    return rf"""
        WITH i AS (SELECT item_id, ws, least({WIDTH}, len(ws)) AS n FROM (SELECT item_id, {words} AS ws FROM benchmark) WHERE len(ws) > 0),
        windows AS (SELECT DISTINCT item_id, n, unnest({grams.format("ws", "n")}) AS gram FROM i),
        d AS (SELECT row_number() OVER () AS id, doc_id, {words} AS ws FROM documents),
        places AS (
            SELECT id, n, unnest({grams.format("ws", "n")}) AS gram, unnest(range(0, len(ws) - n + 1)) AS spot
            FROM d, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n
        ),
        hits AS (SELECT id, spot, n, item_id FROM places JOIN windows USING (n, gram)),
        inside AS (SELECT id, count(DISTINCT word) AS n_hit FROM (SELECT id, unnest(range(spot, spot + n)) AS word FROM (SELECT DISTINCT id, spot, n FROM hits)) GROUP BY id),
        named AS (
            SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY id
        )
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN inside USING (id) LEFT JOIN named USING (id)
    """


def _conversation_repair() -> str:
    """Turn by turn, the cheapest script that leads to each state, of several the least in audit, with its lines.

    States are 0 (nothing yet), s, u and a. A script inserts before it edits the next turn, or at the end.
    """
    costs, states = Costs(), "0sua"
    kept = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    made = {"0": ("user", "u"), "s": ("user", "u"), "u": ("assistant", "a"), "a": ("user", "u")}

    def option(state: str, cost: object, initials: str, added: str = "", when: str = "true") -> str:
        t = f"t{state}"
        lines = f"{t}.lines || CASE WHEN {t}.n > 0 THEN chr(10) ELSE '' END || {added}" if added else f"{t}.lines"
        more = initials.count("I") + (initials[-1] in "KR") if added else 0
        return f"""CASE WHEN {t} IS NOT NULL AND {when} THEN
            struct_pack(cost := {t}.cost + {cost}, audit := {t}.audit || '{initials}', lines := {lines}, n := {t}.n + {more}) END"""

    def best(options: list[str]) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"

    def inserted(state: str) -> str:
        return option(state, costs.insert, "I", f"'{made[state][0]}:'")

    # With one insert more; twice is enough, as a third one leads back to a state at a higher price.
    wider = "SELECT conv_id, i, " + ", ".join(best([f"t{to}", *[inserted(state) for state in states if made[state][1] == to]]) + f" AS t{to}" for to in states)
    stays, free = f"CASE WHEN fault = 't' THEN {costs.truncated} ELSE 0 END", "fault NOT IN ('b', 'd')"
    moved = []
    for to in states:
        options = [option(to, costs.delete, "D")]
        options += [option(before, stays, "K", "role || ':' || text", f"{free} AND left(role, 1) = '{mark}'") for (before, mark), after in kept.items() if after == to]
        options += [option(state, f"{costs.rerole} + {stays}", "R", f"'{role}:' || text", free) for state, (role, after) in made.items() if after == to]
        moved.append(f"{best(options)} AS t{to}")
    empty = "CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR, n BIGINT))"
    ends = best(["t0", "ta", inserted("u"), option("s", 2 * costs.insert, "II", f"'{made['s'][0]}:' || chr(10) || '{made['u'][0]}:'")])
    spaces = "' ' || " + " || ".join(f"chr({code})" for code in range(9, 14))
    # CRC-32 by its reflected polynomial, bit by bit over the bytes of a short ASCII key.
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: {bits}), 4294967295)"
    return rf"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
            FROM conversations
        ),
        fates AS (SELECT *, {crc} % 20 AS fate FROM keyed),
        damaged AS (
            SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM fates WHERE fate <> 0
        ),
        turns AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, rtrim(text, {spaces}) AS shown
            FROM damaged
        ),
        marked AS (
            SELECT *, CASE WHEN shown = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
                   left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
            FROM turns
        ),
        paths AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(cost := CAST(0 AS BIGINT), audit := '', lines := '', n := CAST(0 AS BIGINT)) AS t0, {empty} AS ts, {empty} AS tu, {empty} AS ta
            FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT w.conv_id, m.i, {", ".join(moved)}
            FROM ({wider} FROM ({wider} FROM paths)) AS w JOIN marked AS m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1
        ),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS turns,
                   count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM marked GROUP BY conv_id
        ),
        ended AS (SELECT conv_id, i, {ends} AS e FROM paths)
        SELECT p.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.cost AS cost, e.audit AS audit, sha256(e.lines) AS repaired_sha256
        FROM ended AS p LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM p.conv_id WHERE p.i = coalesce(turns, 0)
    """


ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": _quality_rules(),
    "op11_decontamination": _decontamination(),
    "op12_conversation_repair": _conversation_repair(),
    "op3_ngram_jaccard_join": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
        grams AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(ws) = 0 THEN []
                WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
            END) AS g
            FROM d
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
            FROM grams AS a JOIN grams AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT x, y FROM common JOIN sizes AS s ON s.doc_id = x JOIN sizes AS t ON t.doc_id = y
            WHERE 100 * shared >= 90 * (s.n + t.n - shared)
        ),
        steps AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (
            SELECT doc_id, doc_id AS found FROM d
            UNION
            SELECT reach.doc_id, steps.y FROM reach JOIN steps ON steps.x = reach.found
        )
        SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(found) AS component_id
        FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op9_digest_index": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ),
        groups AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM rows
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM groups
    """,
    "op10_warc": """
        WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
        bits AS (
            SELECT *, max(page_id) OVER (PARTITION BY h) AS response,
                   array_to_string(list_transform(string_split(h, ''), lambda c: right('000' || bin(strpos('0123456789abcdef', c) - 1), 4)), '') AS b
            FROM hashed
        )
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(
                   range(0, 5), lambda j: CAST(substr(b, CAST(5 * k + j + 1 AS BIGINT), 1) AS INTEGER) << CAST(4 - j AS INTEGER))) AS BIGINT), 1)), '') AS payload_digest,
               CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> response THEN response END AS refers_to
        FROM bits
    """,
}

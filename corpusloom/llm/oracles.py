"""SQL twins of those queries of this folder that SQL can say, written from their definitions."""

from __future__ import annotations

from . import decontaminate, license_scan, line_dedup, line_rules

BLANK = r"[\x20\x09-\x0D]"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strings(words) -> str:
    return "[" + ", ".join(map(quoted, words)) + "]"


def license_sql() -> str:
    """Every key phrase at every place of every text; scores from document frequencies."""
    vocabulary = sorted({w for t in license_scan.TEMPLATES for w in t.text.split()})
    found = []
    for t in license_scan.TEMPLATES:
        words, key = t.text.split(), t.key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        found.append(f"""SELECT doc_id, ws, unnest(list_filter(range(1, len(ws) - {len(key) - 2}),
            lambda i: ws[i : i + {len(key) - 1}] = {strings(key)})) AS place, {quoted(t.label)} AS label, {t.base} AS base,
            {at} AS key_at, {strings(words)} AS tw FROM d""")
    return f"""WITH d AS (SELECT doc_id,
        list_filter(string_split_regex({ASCII.format("coalesce(text, '')")}, {quoted(NOT_WORD)}), lambda x: x <> '') AS ws
        FROM documents),
    seen AS (SELECT w, count(*) AS n FROM (SELECT unnest(list_distinct(ws)) AS w FROM d) GROUP BY w),
    idf AS (SELECT w, round(ln(((SELECT count(*) FROM d) + 1)::DOUBLE / (coalesce(n, 0) + 1)) + 1, 6) AS idf
        FROM (SELECT unnest({strings(vocabulary)}) AS w) LEFT JOIN seen USING (w)),
    idfs AS (SELECT map(list(w), list(idf)) AS m FROM idf),
    places AS ({" UNION ALL ".join(found)}),
    matches AS (SELECT doc_id, place - 1 AS start, label, base, round(least(1.0::DOUBLE,
        list_sum(list_transform(range(1, len(tw) + 1), lambda j: CASE WHEN place - key_at + j - 1 >= 1
            AND ws[place - key_at + j - 1] = tw[j] THEN m[tw[j]] ELSE 0.0::DOUBLE END))
        / list_sum(list_transform(tw, lambda x: m[x]))), 6) AS score FROM places, idfs),
    per AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
        max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM matches GROUP BY doc_id)
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
        last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
        coalesce(score, 0.0::DOUBLE) AS score FROM d LEFT JOIN per USING (doc_id)"""


def line_rules_sql() -> str:
    r = line_rules
    notice = " OR ".join(f"contains(lower(l), {quoted(p)})" for p in r.BOILERPLATE)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(t, '{BLANK}+'), lambda x: x <> '') AS ws FROM d),
    grams AS (SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
    twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
    repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) x(k) GROUP BY doc_id),
    ls AS (SELECT doc_id, l, list_filter(string_split_regex(l, '{BLANK}+'), lambda x: x <> '') AS lw
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)),
    judged AS (SELECT doc_id, l, len(lw) AS n, len(lw) > 0 AND (
        (length(l) - length(translate(l, '|»›•·', ''))) * {r.WORDS_PER_BAR} > len(lw)
        OR len(regexp_extract_all(l, '[#*$%&<>=_~^]{{2,}}|[!?]{{2,}}')) > len(lw) * {r.MARKED_SHARE}::DOUBLE
        OR len(list_filter(range(2, len(lw) + 1), lambda k: lw[k] = lw[k - 1])) > len(lw) * {r.STUTTER_SHARE}::DOUBLE
        OR {notice}) AS bad FROM ls),
    per AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_bad_lines,
        count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines,
        coalesce(sum(length(regexp_replace(l, '{BLANK}', '', 'g'))) FILTER (NOT bad), 0) AS kept_chars
        FROM judged GROUP BY doc_id),
    counted AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '{BLANK}', '', 'g')) AS word_chars,
        length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(n, 0) AS n_repeat_words,
        n_lines, n_bad_lines, n_dup_lines, kept_chars FROM w JOIN per USING (doc_id) LEFT JOIN repeats USING (doc_id)),
    failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
        n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
        NOT base_failed AND kept_chars >= {r.LEAST_KEPT}::DOUBLE * word_chars AS kept, n_lines::BIGINT AS n_lines,
        n_bad_lines::BIGINT AS n_bad_lines, kept_chars::BIGINT AS kept_chars FROM failed"""


def line_dedup_sql() -> str:
    """Shortest runs with enough words from every line; all but the first of equal runs go."""
    least = line_dedup.MIN_WORDS
    return f"""WITH all_lines AS (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS line_no
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
    worded AS (SELECT *, len(list_filter(string_split_regex(l, '{BLANK}+'), lambda x: x <> '')) AS n FROM all_lines),
    placed AS MATERIALIZED (SELECT *, row_number() OVER o AS pos, sum(n) OVER o - n AS words_before FROM worded WHERE n > 0
        WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
    ends AS (SELECT a.doc_id, a.pos, a.line_no, min(b.pos) AS last, min(b.line_no) AS last_line
        FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos AND a.pos + {least - 1}
            AND b.words_before + b.n - a.words_before >= {least} GROUP BY ALL),
    listed AS (SELECT doc_id, list(l ORDER BY pos) AS ls FROM placed GROUP BY doc_id),
    runs AS (SELECT doc_id, pos, line_no, last_line, array_to_string(ls[pos : last], chr(10)) AS run
        FROM ends JOIN listed USING (doc_id)),
    later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS k FROM runs) WHERE k > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(line_no, last_line + 1)) AS line_no FROM later),
    removed AS (SELECT doc_id, count(*) AS n, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS nos FROM gone GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(l, chr(10) ORDER BY line_no) AS t FROM all_lines ANTI JOIN gone USING (doc_id, line_no)
        GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_removed, coalesce(nos, '') AS removed, md5(coalesce(t, '')) AS text_md5
    FROM documents LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def leaks_sql() -> str:
    """Every item laid on every document at every shift that has four of five aligned words, word by word."""
    window, least = decontaminate.WINDOW, decontaminate.SIMILARITY
    masks = ((0, 1, 2, 3), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4))

    def words(table: str, name: str) -> str:
        text = ASCII.format("coalesce(text, '')")
        return f"""SELECT {name}, list_filter(string_split_regex({text}, {quoted(NOT_WORD)}), lambda x: x <> '') AS ws
        FROM {table}"""

    def seeds(table: str, name: str) -> str:
        parts = []
        for k, places in enumerate(masks):
            key = " || ' ' || ".join(f"ws[i + {p}]" for p in places)
            parts.append(f"""SELECT {name}, i, {k} AS mask, {key} AS key
            FROM (SELECT *, unnest(range(1, len(ws) - {places[-1] - 1})) AS i FROM {table})""")
        return " UNION ALL ".join(parts)

    return f"""WITH d AS MATERIALIZED ({words("documents", "doc_id")}), b AS MATERIALIZED ({words("benchmark", "item_id")}),
    shifts AS (SELECT DISTINCT doc_id, item_id, x.i - y.i AS shift FROM ({seeds("d", "doc_id")}) x
        JOIN ({seeds("b", "item_id")}) y USING (mask, key)),
    compared AS (SELECT doc_id, item_id, len(d.ws) AS doc_words, len(b.ws) AS n, list_transform(range(1, len(b.ws) + 1),
        lambda j: CASE WHEN shift + j >= 1 AND shift + j <= len(d.ws) AND d.ws[shift + j] = b.ws[j] THEN 1 ELSE 0 END) AS same
        FROM shifts JOIN d USING (doc_id) JOIN b USING (item_id)),
    judged AS (SELECT *, list_sum(same) AS same_words, greatest(list_sum(same)::DOUBLE / n, list_max(list_transform(
        range(1, n - least(n, {window}) + 2), lambda s: list_sum(same[s : s + least(n, {window}) - 1])::DOUBLE
            / least(n, {window})))) AS best FROM compared)
    SELECT doc_id, item_id, max(doc_words)::BIGINT AS doc_words, max(n)::BIGINT AS item_words,
        max(same_words)::BIGINT AS same_words, round(max(best), 6) AS best_window
    FROM judged WHERE best >= {least}::DOUBLE GROUP BY doc_id, item_id"""


ORACLES = {
    "op1_license_scan": license_sql(),
    "op2_spaced_seeds": leaks_sql(),
    "op6_line_rules": line_rules_sql(),
    "op8_line_suffixes": line_dedup_sql(),
}

"""SQL spellings of the text functions, for the queries' reference SQL."""

from __future__ import annotations

from ..functions.authors import ENDING, JOINER, STOP
from ..functions.text import BLANK, LABEL_DIGITS, LABEL_LETTERS, LINE_END


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def strip(x: str) -> str:
    return sub(x, f"^{BLANK}+|{BLANK}+$")


def squeeze(x: str) -> str:
    return strip(sub(x, f"{BLANK}+", " "))


def tidy_spaces(x: str) -> str:
    return strip(sub(f"replace({x}, chr(9), ' ')", " {2,}", " "))


def tidy_block(x: str) -> str:
    lines = f"list_transform(regexp_split_to_array({x}, {q(LINE_END)}), lambda tl: {tidy_spaces('tl')})"
    return strip(sub(f"array_to_string({lines}, chr(10))", r"\n{3,}", "\n\n"))


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def count_of(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {q(pattern)}))"


def letters(x: str) -> str:
    return f"length({sub(x, r'[^\p{L}]')})"


def garbage(x: str) -> str:
    solid, signs = f"length({sub(x, BLANK)})", f"length({sub(x, r'[^~`!@#$%^&*\\|/<>{}\[\]]')})"
    return f"({solid} > 0 AND (({solid} < 60 AND 2 * {letters(x)} < {solid}) OR ({signs} >= 4 AND 20 * {letters(x)} < 13 * {solid})))"


def ascii_only(x: str) -> str:
    return sub(f"strip_accents({x})", r"[^\x00-\x7F]")


_WIDE = "".join(chr(0xFF01 + i) for i in range(94))
_BOLD = "".join(chr(0x1D400 + i) for i in range(52))
_NARROW = "".join(chr(0x21 + i) for i in range(94)) + "".join(chr(65 + i) for i in range(26)) + "".join(chr(97 + i) for i in range(26)) + "K"


def compat_ascii(x: str) -> str:
    """Compatibility decomposition to ASCII, for the forms the tables hold."""
    wide = f"translate({x}, {q(_WIDE + _BOLD + chr(0x212A))}, {q(_NARROW)})"
    for bad, good in (("ﬃ", "ffi"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff")):
        wide = f"replace({wide}, {q(bad)}, {q(good)})"
    return ascii_only(wide)


def normal_label(x: str) -> str:
    s = strip(x)
    prefix = f"upper(regexp_extract({s}, '^(?i)(HP|SS|[TP])', 1))"
    rest = sub(f"translate(substr({s}, length({prefix}) + 1), {q(LABEL_LETTERS)}, {q(LABEL_DIGITS)})", "[^0-9]")
    return f"CASE WHEN {rest} = '' THEN {s} ELSE {prefix} || {rest} END"


def label_kind(x: str) -> str:
    s = f"upper({strip(x)})"
    return f"CASE WHEN starts_with({s}, 'HP') THEN 'honours_poster' WHEN starts_with({s}, 'SS') THEN 'special' WHEN starts_with({s}, 'P') THEN 'poster' ELSE 'talk' END"


def _edge(x: str, marks: str) -> str:
    return sub(strip(x), f"[{marks}]+$")


def _words(x: str, var: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda {var}: {var} <> '')"


def split_names(x: str) -> str:
    whole = _edge(sub(f"coalesce({x}, '')", ENDING), ",;")
    parts = f"list_filter(list_transform(regexp_split_to_array({whole}, {q(JOINER)}), lambda np: {_edge('np', ',;.')}), lambda np: np <> '')"
    pieces = f"list_transform(string_split(np, ','), lambda nx: {strip('nx')})"
    solid = f"list_filter({pieces}, lambda nx: nx <> '')"
    short = f"len({_words('nx', 'nw')})"
    pair = f"(len({pieces}) = 2 AND list_bool_and(list_transform({pieces}, lambda nx: {short} BETWEEN 1 AND 4 AND {matches('nx', r'^\p{Lu}')})))"
    first = f"({pair} AND len({_words(f'({pieces})[1]', 'nw')}) = 1)"
    small = f"list_bool_and(list_transform({solid}, lambda nx: {short} <= 5))"
    each = f"CASE WHEN NOT contains(np, ',') OR {first} THEN [np] WHEN {pair} OR {small} THEN {solid} ELSE [np] END"
    return f"list_filter(list_transform(flatten(list_transform({parts}, lambda np: {each})), lambda np: {_edge('np', ',;.')}), lambda np: np <> '')"


def surname_first(x: str) -> str:
    name = _edge(x, ",.")
    words = _words(name, "sw")
    after = f"regexp_extract({name}, '(?s)^[^,]*,(.*)$', 1)"
    return f"CASE WHEN contains({name}, ',') THEN {strip(f'split_part({name}, {q(chr(44))}, 1)')} || ', ' || {strip(after)} WHEN len({words}) <= 1 THEN {name} ELSE ({words})[-1] || ', ' || array_to_string(({words})[:-2], ' ') END"


def author_field_from(names: str, raw: str) -> str:
    return f"CASE WHEN len({names}) = 0 THEN coalesce({raw}, '') ELSE array_to_string(list_transform({names}, lambda an: {surname_first('an')}), ' and ') END"


def first_surname_from(names: str) -> str:
    f = f"({names})[1]"
    last = f"(regexp_split_to_array({strip(f)}, '\\s+'))[-1]"
    return f"coalesce(nullif(CASE WHEN contains({f}, ',') THEN {strip(f'split_part({f}, {q(chr(44))}, 1)')} ELSE {last} END, ''), 'anon')"


def title_word(x: str) -> str:
    words = f"list_filter(regexp_split_to_array({sub(ascii_only(f'coalesce({x}, {q(chr(0)[:0])})'), '[^A-Za-z ]', ' ')}, ' +'), lambda tw: tw <> '')"
    stop = ", ".join(map(q, STOP))
    telling = f"list_filter({words}, lambda tw: length(tw) >= 3 AND lower(tw) NOT IN ({stop}))"
    return f"coalesce(lower(substr(({telling})[1], 1, 12)), lower(substr(({words})[1], 1, 12)), 'x')"


def clean_surname(x: str) -> str:
    last = f"split_part({x}, ',', 1)"
    return f"(length({last}) BETWEEN 2 AND 25 AND {matches(last, r'''^[A-Za-z\s,.\-']*$''')} AND {matches(last, '[aeiouyAEIOUY]')})"


def identity_ctes(source: str) -> str:
    """CTEs from ``source`` (…, name) to ``who`` (…, display, key)."""
    words = lambda x, v: _words(x, v)
    return f"""
    i1 AS (SELECT *, {sub(compat_ascii('name'), r'^\s+|\s+$')} AS s0 FROM {source}),
    i2 AS (SELECT *, {strip("split_part(" + sub('s0', '^[.,;:]+|[.,;:]+$') + ", ';', 1)")} AS s1 FROM i1),
    i3 AS (SELECT *, {words('s1', 'iw')} AS ws, contains(s1, ',') AS has_comma FROM i2),
    i4 AS (SELECT *, CASE WHEN has_comma THEN {strip("split_part(s1, ',', 1)")} ELSE coalesce(ws[-1], '') END AS last0,
             CASE WHEN has_comma THEN coalesce(({words("regexp_extract(s1, '(?s)^[^,]*,(.*)$', 1)", 'iw')})[1], '') WHEN len(ws) > 1 THEN ws[1] ELSE '' END AS first0 FROM i3),
    i5 AS (SELECT *, has_comma AND regexp_matches(last0, '^[A-Z]{{1,3}}$') AND regexp_matches(first0, '^[A-Z].{{2,}}') AND first0 <> upper(first0) AS turned FROM i4),
    i6 AS (SELECT *, CASE WHEN turned THEN first0 ELSE last0 END AS la, CASE WHEN turned THEN last0 ELSE first0 END AS fi FROM i5),
    i7 AS (SELECT *, {strip(sub("lower(" + sub('la', r'[^\w\s]') + ")", r'\s+', ' '))} AS stem, lower(substr({strip(sub('fi', r'[^\w\s]', ' '))}, 1, 1)) AS ini FROM i6),
    who AS (SELECT *, CASE WHEN stem <> '' AND ini <> '' THEN stem || '|' || ini ELSE stem END AS key,
              CASE WHEN {strip('fi')} <> '' THEN {strip('la')} || ', ' || {sub(strip('fi'), r'\.+$')} ELSE {strip('la')} END AS display FROM i7)"""

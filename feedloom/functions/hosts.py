"""Host names as requests need them: ``xn--`` labels and shortest IPv6 addresses, as SQL text.

Names are mapped by rule: small letters, full-width signs to ASCII, the ideographic full stops to a dot,
invisible joiners dropped. Labels are expected to be composed (NFC); combining marks are kept as they are.
"""

from __future__ import annotations

from .values import sql_let

# Parameters of the bootstring encoding of host names.
BASE, T_MIN, T_MAX, SKEW, DAMP, FIRST_BIAS, FIRST_CODE = 36, 1, 26, 38, 700, 72, 128
DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"

# Full-width forms of the printable ASCII signs, and signs that end a label like the dot.
_WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
_NARROW = "".join(chr(c) for c in range(0x21, 0x7F))
_STOPS = "\u3002\uff61"
_INVISIBLE = "\u00ad\u200b\u2060\ufeff"


def _text(t: str) -> str:
    """SQL: a literal."""
    escaped = t.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _digits(delta: str, bias: str) -> str:
    """SQL: a number in digits of falling thresholds, the least first."""
    threshold = f"cast(greatest({T_MIN}, least({T_MAX}, {BASE} * i - {bias})) as bigint)"
    last = f"named_struct('q', v.q, 'out', concat(v.out, substr('{DIGITS}', cast(v.q as int) + 1, 1)), 'done', true)"
    more = (
        f"named_struct('q', (v.q - t) div ({BASE} - t), 'out',"
        f" concat(v.out, substr('{DIGITS}', cast(t + (v.q - t) % ({BASE} - t) as int) + 1, 1)), 'done', false)"
    )
    step = sql_let("t", threshold, f"case when v.q < t then {last} else {more} end")
    return (
        f"aggregate(sequence(1, 12), named_struct('q', cast({delta} as bigint), 'out', '', 'done', false),"
        f" (v, i) -> case when v.done then v else {step} end, v -> v.out)"
    )


def _adapted(delta: str, points: str, first: str) -> str:
    """SQL: the bias after a number was written."""
    most = (BASE - T_MIN) * T_MAX // 2
    halved = f"case when {first} then {delta} div {DAMP} else {delta} div 2 end"
    return sql_let(
        "half",
        f"cast({halved} as bigint)",
        f"aggregate(sequence(1, 8), named_struct('d', half + half div {points}, 'k', cast(0 as bigint)),"
        f" (a, i) -> case when a.d > {most} then named_struct('d', a.d div {BASE - T_MIN}, 'k', a.k + {BASE}) else a end,"
        f" a -> a.k + ({BASE - T_MIN + 1} * a.d) div (a.d + {SKEW}))",
    )


def ascii_label(label: str) -> str:
    """SQL: the ``xn--`` form of a mapped label with signs outside ASCII.

    The signs outside ASCII are inserted in the order of their codes; what is written is how many places
    and codes were passed over since the last insertion.
    """
    codes = rf"transform(regexp_extract_all({label}, r'(?s).', 0), sign -> cast(ascii(sign) as bigint))"
    insert = (
        "case when c < m then named_struct('delta', e.delta + 1, 'bias', e.bias, 'h', e.h, 'out', e.out)"
        f" when c = m then named_struct('delta', cast(0 as bigint), 'bias', {_adapted('e.delta', '(e.h + 1)', 'e.h = b')},"
        f" 'h', e.h + 1, 'out', concat(e.out, {_digits('e.delta', 'e.bias')})) else e end"
    )
    start = "named_struct('delta', s.delta + (m - s.n) * (s.h + 1), 'bias', s.bias, 'h', s.h, 'out', s.out)"
    round_ = sql_let(
        "r",
        f"aggregate(codes, {start}, (e, c) -> {insert})",
        "named_struct('n', m + 1, 'delta', r.delta + 1, 'bias', r.bias, 'h', r.h, 'out', r.out)",
    )
    first = f"named_struct('n', cast({FIRST_CODE} as bigint), 'delta', cast(0 as bigint), 'bias', cast({FIRST_BIAS} as bigint), 'h', b, 'out', '')"
    marks = f"array_sort(array_distinct(filter(codes, c -> c >= {FIRST_CODE})))"
    written = f"aggregate({marks}, {first}, (s, m) -> {round_}, s -> concat('xn--', basic, case when b > 0 then '-' else '' end, s.out))"
    bound = sql_let("b", "cast(length(basic) as bigint)", written)
    return sql_let("codes", codes, sql_let("basic", rf"regexp_replace({label}, r'[^\x00-\x7f]', '')", bound))


def ascii_domain(name: str) -> str:
    """SQL: a host name in ASCII and small letters, label by label."""
    mapped = f"lower(replace(translate(regexp_replace({name}, {_text('[' + _INVISIBLE + ']')}, ''), {_text(_WIDE + _STOPS)}, {_text(_NARROW + '..')}), 'Σ', 'σ'))"
    label = rf"case when label rlike r'[^\x00-\x7f]' then {ascii_label('label')} else label end"
    return rf"array_join(transform(split({mapped}, r'\.'), label -> {label}), '.')"


def short_ipv6(raw: str) -> str:
    """SQL: a bracketed address with its first longest run of zeros left out, or NULL where it is none."""
    part = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    # The last two groups may be a dotted address.
    two = "concat(lower(hex(cast(q[0] as int) * 256 + cast(q[1] as int))), ':', lower(hex(cast(q[2] as int) * 256 + cast(q[3] as int))))"
    dotted = sql_let("q", r"split(regexp_extract(inner, r'([^:]*)$', 1), r'\.')", rf"concat(regexp_extract(inner, r'^(.*:)[^:]*$', 1), {two})")
    groups = rf"case when not contains(inner, '.') then inner when inner rlike r'^[0-9a-f:]*:{part}(?:\.{part}){{3}}$' then {dotted} end"
    side = "case when {0} = '' then cast(array() as array<string>) else split({0}, ':') end"
    filled = sql_let(
        "left",
        side.format("sides[0]"),
        sql_let(
            "right",
            side.format("sides[1]"),
            "case when size(left) + size(right) <= 7 then concat(left, array_repeat('0', 8 - size(left) - size(right)), right) end",
        ),
    )
    all_groups = sql_let("sides", "split(groups, '::')", f"case size(sides) when 1 then split(groups, ':') when 2 then {filled} end")
    cut = (
        r"concat(regexp_replace(regexp_extract(flat, concat('^((?:[0-9a-f]+:)*?)0(?::0){', run - 1, '}(?::|$)'), 1), ':$', ''), '::',"
        r" regexp_extract(flat, concat('^(?:[0-9a-f]+:)*?0(?::0){', run - 1, '}(?::|$)(.*)$'), 1))"
    )
    runs = "filter(sequence(8, 2, -1), k -> flat rlike concat('(^|:)0(:0){', k - 1, '}(:|$)'))"
    short = sql_let("run", f"get({runs}, 0)", f"case when run is null then flat else {cut} end")
    flat = r"array_join(transform(parts, g -> regexp_replace(g, r'^0+(?=.)', '')), ':')"
    checked = f"case when size(parts) = 8 and forall(parts, g -> g rlike r'^[0-9a-f]{{1,4}}$') then concat('[', {sql_let('flat', flat, short)}, ']') end"
    return sql_let("inner", f"lower(substr({raw}, 2, length({raw}) - 2))", sql_let("groups", groups, sql_let("parts", all_groups, checked)))

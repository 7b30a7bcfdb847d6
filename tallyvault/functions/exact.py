"""Numbers of any size: as plain text, as limbs that add up without overflow, and back to text.

A limb is nine decimal digits at a place: place 0 holds the nine digits before the point, place 1 the nine
before these, place -1 the nine behind the point. Limbs of one place are summed as decimals, so a sum of
any number of amounts never meets the end of a type, and carries are taken once at the end. Like the
parsers, these build SQL text from built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMB = 9
# The most digits a number may have before and behind its point.
WHOLE_DIGITS, FRACTION_DIGITS = 131_072, 16_383

NUMBER = r"^([+-]?)(?=\.?\d)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\z"
SUM = "decimal(28,0)"  # of whole numbers of 20 digits: a sum takes ten digits more


def bound(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def plain_text(t: str) -> str:
    """The number in text ``t`` without exponent and idle zeros: ``-12.5``; NULL for other text.

    A number of more digits than the limits above, or a zero exponent of more than nine digits, is NULL.
    """
    parts = ", ".join(f"'{name}', regexp_extract({t}, r'{NUMBER}', {k})" for name, k in (("s", 1), ("w", 2), ("f", 3), ("e", 4)))
    digits = "named_struct('s', n.s, 'd', concat(n.w, n.f), 'p', length(n.w) + coalesce(try_cast(nullif(n.e, '') AS int), 0))"
    # digits in front are idle: 007 has its point after one digit
    idle = "length(n.d) - length(ltrim('0', n.d))"
    short = f"named_struct('s', n.s, 'd', trim('0' FROM n.d), 'p', n.p - ({idle}))"
    fits = f"n.p <= {WHOLE_DIGITS} AND length(n.d) - n.p <= {FRACTION_DIGITS}"
    whole = "CASE WHEN n.p <= 0 THEN '0' WHEN n.p >= length(n.d) THEN rpad(n.d, n.p, '0') ELSE left(n.d, n.p) END"
    fraction = (
        "CASE WHEN n.p <= 0 THEN concat('.', repeat('0', -n.p), n.d)"
        " WHEN n.p >= length(n.d) THEN '' ELSE concat('.', substr(n.d, n.p + 1)) END"
    )
    text = f"CASE WHEN n.d = '' THEN '0' WHEN {fits} THEN concat(if(n.s = '-', '-', ''), {whole}, {fraction}) END"
    usable = f"(nullif(regexp_extract({t}, r'{NUMBER}', 4), '') IS NULL OR try_cast(regexp_extract({t}, r'{NUMBER}', 4) AS int) BETWEEN -999999999 AND 999999999)"
    built = bound("n", f"named_struct({parts})", bound("n", digits, bound("n", short, text)))
    return f"CASE WHEN {t} RLIKE r'{NUMBER}' AND {usable} THEN {built} END"


def limbs(text: str) -> str:
    """array<struct<place int, part int>> of a positive number in plain text; limbs of zeros are left out."""
    split = f"named_struct('w', substring_index({text}, '.', 1), 'f', if(contains({text}, '.'), substring_index({text}, '.', -1), ''))"
    padded = (
        f"named_struct('w', lpad(n.w, cast(ceil(length(n.w) / {LIMB}D) * {LIMB} AS int), '0'),"
        f" 'f', rpad(n.f, cast(ceil(length(n.f) / {LIMB}D) * {LIMB} AS int), '0'))"
    )
    every = (
        "transform(sequence(1, (length(n.w) + length(n.f)) div {k}), i -> named_struct("
        "'place', cast(length(n.w) div {k} - i AS int),"
        " 'part', cast(substr(concat(n.w, n.f), cast((i - 1) * {k} + 1 AS int), {k}) AS int)))"
    ).format(k=LIMB)
    return f"filter({bound('n', split, bound('n', padded, every))}, x -> x.part <> 0)"


def number_limbs(number: Decimal) -> list[tuple[int, int]]:
    """(place, part) of a positive number."""
    whole, _, fraction = f"{number:f}".partition(".")
    whole = whole.rjust(-(-len(whole) // LIMB) * LIMB, "0")
    fraction = fraction.ljust(-(-len(fraction) // LIMB) * LIMB, "0")
    digits, places = whole + fraction, len(whole) // LIMB
    found = [(places - 1 - i, int(digits[i * LIMB : (i + 1) * LIMB])) for i in range(len(digits) // LIMB)]
    return [(place, part) for place, part in found if part]


def total_text(sums: str) -> str:
    """Plain text of what array<struct<place int, part decimal>> adds up to, carries taken.

    A place may stand there several times; parts are whole and not negative.
    """
    unit = f"{10**LIMB}BD"
    ends = (
        f"named_struct('all', {sums}, 'low', least(0, array_min(transform({sums}, x -> x.place))),"
        f" 'high', greatest(0, array_max(transform({sums}, x -> x.place))))"
    )
    here = "aggregate(filter(m.all, x -> x.place = p), a.carry, (s, x) -> cast(s + x.part AS decimal(38,0)))"
    step = bound(
        "v",
        here,
        f"named_struct('carry', cast((v - v % {unit}) / {unit} AS decimal(38,0)),"
        f" 'text', concat(lpad(cast(cast(v % {unit} AS int) AS string), {LIMB}, '0'), a.text))",
    )
    start = "named_struct('carry', cast(0 AS decimal(38,0)), 'text', '')"
    folded = f"aggregate(sequence(m.low, m.high), {start}, (a, p) -> {step}, a -> concat(cast(a.carry AS string), a.text))"
    point = f"length(r.t) + m.low * {LIMB}"
    whole = f"coalesce(nullif(ltrim('0', left(r.t, {point})), ''), '0')"
    fraction = f"rtrim('0', substr(r.t, {point} + 1))"
    text = bound("r", f"named_struct('t', {folded})", f"concat({whole}, if({fraction} = '', '', concat('.', {fraction})))")
    return f"CASE WHEN size({sums}) > 0 THEN {bound('m', ends, text)} ELSE '0' END"


def amount_sums(rows: DataFrame, keys: Sequence[str], amount: str, wide: str) -> DataFrame:
    """(*keys, place, whole, fraction): sums of amounts that column ``amount`` or the text ``wide`` holds.

    A decimal is one row of place 0, its whole part and its fraction apart; only a wide number is cut
    into limbs. Neither sum can overflow, and map tasks fold their own first.
    """
    small = (
        f"array(named_struct('place', 0, 'whole', cast(floor({amount}) AS {SUM}),"
        f" 'fraction', cast({amount} - floor({amount}) AS decimal(28,18))))"
    )
    large = (
        f"transform({limbs(wide)}, x -> named_struct('place', x.place, 'whole', cast(x.part AS {SUM}),"
        " 'fraction', cast(0 AS decimal(28,18))))"
    )
    return added(rows.select(*keys, F.expr(f"inline(if({wide} IS NULL, {small}, {large}))")), keys)


def added(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums (*keys, place, whole, fraction) folded to one row per place."""
    return parts.groupBy(*keys, "place").agg(
        F.sum("whole").alias("whole"), F.sum("fraction").alias("fraction")
    )


SUM_LIMBS = (
    f"concat(transform({limbs('cast(whole AS string)')}, x -> named_struct('place', x.place + place, 'part', x.part)),"
    f" {limbs('cast(fraction AS string)')})"
)


def totals(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(*keys, name): limbs (*keys, place, part) as plain text; a place may stand in several rows."""
    gathered = parts.groupBy(*keys).agg(F.collect_list(F.struct("place", "part")).alias("_parts"))
    return gathered.select(*keys, F.expr(total_text("_parts")).alias(name))


def by_size(text: str) -> list:
    """Sort columns that put larger numbers in positive plain text first."""
    whole = F.substring_index(text, ".", 1)
    return [F.desc(F.length(whole)), F.desc(whole), F.desc(text)]

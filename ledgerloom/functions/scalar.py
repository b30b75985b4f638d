"""Scalar functions as built-in Column expressions; everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURE_TYPE = T.DecimalType(36, 12)

# Subscript digits and the digits they stand for.
SUBSCRIPT_DIGITS = "₀₁₂₃₄₅₆₇₈₉"
PLAIN_DIGITS = "0123456789"

# Location levels from widest to narrowest, as ranked in the report.
LOCATION_LEVELS = ("location", "company", "site")

# Placeholder unit texts that count as "no unit".
PLACEHOLDER_UOMS = ("UOM", "UoM", "0")

# Fixed value: the text that stands for NULL when changes are compared as text.
NULL_SENTINEL = "**NULL**"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once; keeps large expressions from being repeated in the plan."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- text and key normalisation ------------------------------------------------------------


def clean_ref(ref: Column | str) -> Column:
    """Trim an input reference and turn subscript digits into plain ones."""
    return F.translate(trim_ws(_col(ref).cast("string")), SUBSCRIPT_DIGITS, PLAIN_DIGITS)


def trim_ws(text: Column | str) -> Column:
    """Strip leading and trailing white space of any kind, not only blanks."""
    return F.regexp_replace(_col(text), r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def key_text(c: Column | str) -> Column:
    """Upper-cased, trimmed key text."""
    return F.upper(trim_ws(_col(c).cast("string")))


def blank_fallback(first: Column | str, second: Column | str) -> Column:
    """First value unless it is NULL or empty, else the second."""
    return F.coalesce(F.nullif(_col(first), F.lit("")), _col(second))


def matrix_id(kpi_id: Column | str, kpi_dim_id: Column | str) -> Column:
    """``<kpi>_<dim>``; NULL if either part is NULL."""
    return F.concat(_col(kpi_id).cast("string"), F.lit("_"), _col(kpi_dim_id).cast("string"))


def sort_key(kpi_id: Column | str) -> Column:
    """First run of digits in the id, as a double (NULL if there is none)."""
    return F.regexp_extract(_col(kpi_id), r"(\d+)", 1).try_cast("double")


def engine_key(matrix: Column | str, date_key: Column | str) -> Column:
    """SHA-256 hex of ``<matrix>||<YYYY-MM-DD>``; a NULL matrix id becomes ``NA``."""
    text = F.concat(
        F.coalesce(_col(matrix), F.lit("NA")), F.lit("||"), F.date_format(_col(date_key), "yyyy-MM-dd")
    )
    return F.sha2(text, 256)


def key_bytes(key: Column | str) -> Column:
    """A key text in fewer bytes for shuffles: the 64 hex digits of an engine key as 32 bytes, any other text behind 33 zeros.

    Different texts stay different; NULL stays NULL. Order is that of ``key_of_bytes``."""
    k = _col(key)
    packed = (F.length(k) == 64) & k.rlike("^[0-9a-f]{64}$")
    return F.when(packed, F.unhex(k)).otherwise(F.concat(F.lit(bytes(33)), k.cast("binary")))


def key_of_bytes(packed: Column | str) -> Column:
    """The key text of ``key_bytes``."""
    b = _col(packed)
    return F.when(F.length(b) == 32, F.lower(F.hex(b))).otherwise(F.substring(b, 34, 2**31 - 1).cast("string"))


def display_id(prefix: str, year: Column | str | int, number: Column | str, width: int, compat: bool = False) -> Column:
    """``PREFIX-YEAR-0001``. LPAD cuts numbers wider than ``width``, so ids would collide beyond it;
    wider numbers are kept whole unless ``compat`` asks for the cut."""
    year_text = F.lit(str(year)) if isinstance(year, int) else _col(year).cast("string")
    digits = _col(number).cast("string")
    padded = F.lpad(digits, width, "0")
    if not compat:
        padded = F.when(F.length(digits) > width, digits).otherwise(padded)
    return F.concat(F.lit(f"{prefix}-"), year_text, F.lit("-"), padded)


# --- numbers ------------------------------------------------------------------------------


def to_measure(x: Column | str) -> Column:
    """DECIMAL(36,12), half-up. Unparsable, non-finite and |x| >= 1e16 become 0."""
    d = _col(x).try_cast("double")
    usable = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(1e16))
    return F.when(usable, d.cast(MEASURE_TYPE)).otherwise(F.lit(0).cast(MEASURE_TYPE))


def number(x: Column | str, kind: str = "double") -> Column:
    """Numeric coercion with NULL on bad text."""
    return _col(x).try_cast(kind)


def variance(actual: Column | str, plan: Column | str) -> Column:
    return _col(actual) - _col(plan)


def variance_pct(actual: Column | str, plan: Column | str) -> Column:
    """(actual - plan) / plan * 100; NULL when the plan is 0 or NULL."""
    a, p = _col(actual), _col(plan)
    diff = (a - p).cast("double")
    return F.try_divide(diff, p.cast("double")) * F.lit(100.0)


def adjustment_delta(original: Column | str, adjusted: Column | str) -> Column:
    """Adjusted minus original; with nothing (or 0) adjusted, the original itself."""
    zero = F.lit(0)
    o, a = F.coalesce(_col(original), zero), F.coalesce(_col(adjusted), zero)
    return F.when(a == zero, o).otherwise(a - o)


# --- dates --------------------------------------------------------------------------------


def fiscal_year(d: Column | str) -> Column:
    """July-June fiscal year, named after the calendar year of its June."""
    return F.year(F.add_months(_col(d).cast("date"), 6))


def fiscal_month(d: Column | str) -> Column:
    """1 = July ... 12 = June."""
    return F.month(F.add_months(_col(d).cast("date"), 6))


def fiscal_period(year: int, month: int) -> tuple[int, int]:
    """The same calendar rule for a plain year and month."""
    return (year + (month > 6), (month + 5) % 12 + 1)


def fiscal_year_label(fy: Column | str) -> Column:
    return F.concat(F.lit("FY"), _col(fy).cast("string"))


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d).cast("date"), "MM")


def period_date(year: Column | str, month: Column | str) -> Column:
    return F.make_date(_col(year), _col(month), F.lit(1))


def on_or_before_month(d: Column | str, as_of: Column | str) -> Column:
    return month_start(d) <= month_start(as_of)


def just_before(ts: Column | str) -> Column:
    """The instant one millisecond earlier; end of validity of a superseded row."""
    return _col(ts) - F.expr("INTERVAL '0.001' SECOND")


# --- classification -----------------------------------------------------------------------


def source_kind(source: Column | str) -> Column:
    s = _col(source)
    return (
        F.when(s == "Calculated from other KPIs", "CALCULATED KPI").when(s.isNull(), "N/A").otherwise("BASE KPI")
    )


def scenario_label(scenario: Column | str) -> Column:
    s = _col(scenario)
    return F.when(s == "Budgets", "Budget").otherwise(s)


def or_unknown(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("Unknown"))


def usable_uom(uom: Column | str) -> Column:
    u = _col(uom)
    return u.isNotNull() & ~u.isin(*PLACEHOLDER_UOMS)


def numeric_text(c: Column | str) -> Column:
    """True for text of ASCII digits only."""
    return _col(c).cast("string").rlike("^[0-9]+$")


def level_rank(level: Column | str) -> Column:
    """Position of a location level in the ranking; 0 for an unknown level, NULL for NULL."""
    ranking = F.array(*[F.lit(v) for v in LOCATION_LEVELS])
    return F.array_position(ranking, F.lower(_col(level)))


# --- change detection ---------------------------------------------------------------------


def value_changed(a: Column, b: Column, compat: bool = False) -> Column:
    """True when two values differ as text, NULLs comparing equal to each other.

    ``compat`` compares through a sentinel text, which makes the literal sentinel equal to NULL."""
    a, b = a.cast("string"), b.cast("string")
    if compat:
        return F.coalesce(a, F.lit(NULL_SENTINEL)) != F.coalesce(b, F.lit(NULL_SENTINEL))
    return ~a.eqNullSafe(b)


def any_of(conditions: Iterable[Column], empty: bool = False) -> Column:
    items = list(conditions)
    return reduce(lambda x, y: x | y, items) if items else F.lit(empty)


def all_of(conditions: Iterable[Column], empty: bool = True) -> Column:
    items = list(conditions)
    return reduce(lambda x, y: x & y, items) if items else F.lit(empty)


# --- number texts used in the audit columns -----------------------------------------------


def float_text(x: Column | str) -> Column:
    """Text of a double the way a formula shows it: ``5.0``, ``1e-05``, ``1e+16``, ``nan``.

    The JVM switches to ``d.dddEn`` below 1e-3 and from 1e7 on; the shown form does so below 1e-4
    and from 1e16 on, with a two-digit exponent."""
    d = _col(x)
    raw = d.cast("string")
    plain = ~raw.contains("E")
    # the JVM may print up to 18 digits where fewer identify the number
    long_form = F.length(F.regexp_replace(raw, r"E.*|[-.]", "")) > 16
    tries = [F.format_string(f"%.{n}e", d) for n in (14, 15, 16)]
    short = F.coalesce(*[F.when(t.try_cast("double") == d, t) for t in tries], raw)

    def parts(shown: Column) -> Column:
        sci = r"^-?(\d)\.(\d+)[Ee]([+-]?\d+)$"
        return F.struct(
            F.regexp_extract(shown, sci, 1).alias("head"),
            F.regexp_replace(F.regexp_extract(shown, sci, 2), r"0+$", "").alias("tail"),
            F.regexp_extract(shown, sci, 3).try_cast("int").alias("exp"),
        )

    def rewritten(p: Column) -> Column:
        head, tail, exp = p["head"], p["tail"], p["exp"]
        digits = F.concat(head, tail)
        rest = F.substring(digits, exp + F.lit(2), F.lit(20))
        fixed = F.concat(
            F.rpad(F.substring(digits, 1, 17), exp + 1, "0"), F.lit("."), F.when(rest == "", "0").otherwise(rest)
        )
        scientific = F.concat(
            head,
            F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)),
            F.when(exp < 0, "e-").otherwise("e+"),
            F.when(F.abs(exp) < 10, "0").otherwise(""),
            F.abs(exp).cast("string"),
        )
        return (
            F.when(exp.between(7, 15), fixed).when(exp == -4, F.concat(F.lit("0.000"), digits)).otherwise(scientific)
        )

    body = let(let(F.when(long_form, short).otherwise(raw), parts), rewritten)
    sign = F.when(d < 0, "-").otherwise("")
    return (
        F.when(d.isNull() | F.isnan(d), "nan")
        .when(F.abs(d) == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
        .when(plain, raw)
        .otherwise(F.concat(sign, body))
    )


def whole_digits(whole: Column) -> Column:
    """The decimal digits of a finite double that is a whole number and not negative.

    The number is cut into 24-bit pieces, which is exact, and its digits grow from the highest piece down: nine of them to a
    limb, lowest limb first, with one carry over the limbs for each piece. A small number has few pieces and limbs."""
    base, limb = 1 << 24, 10**9

    def piece(i: Column) -> Column:
        scaled = whole / F.pow(F.lit(float(base)), i)
        return F.try_mod(scaled - F.try_mod(scaled, F.lit(1.0)), F.lit(float(base))).cast("bigint")

    def push(limbs: Column, i: Column) -> Column:
        def carried(state: Column, x: Column) -> Column:
            total = x * base + state["carry"]
            # a multiple of the limb below 2^62 is a double without loss
            above = ((total - total % limb) / limb).cast("bigint")
            return F.struct(F.concat(state["limbs"], F.array(total % limb)).alias("limbs"), above.alias("carry"))

        start = F.struct(F.array().cast("array<bigint>").alias("limbs"), piece(i).alias("carry"))
        return let(
            F.aggregate(limbs, start, carried),
            lambda end: F.when(end["carry"] > 0, F.concat(end["limbs"], F.array(end["carry"]))).otherwise(end["limbs"]),
        )

    top = F.floor(F.log2(F.greatest(whole, F.lit(1.0))) / 24).cast("int")
    limbs = F.aggregate(F.sequence(top + 1, F.lit(0), F.lit(-1)), F.array().cast("array<bigint>"), push)
    text = F.aggregate(
        F.reverse(limbs), F.lit(""), lambda shown, x: F.concat(shown, F.when(shown == "", x.cast("string")).otherwise(F.lpad(x.cast("string"), 9, "0")))
    )
    return let(text, lambda shown: F.when(shown == "", "0").otherwise(shown))


def signed_fixed(x: Column | str, digits: Column | int = 15) -> Column:
    """Signed text with ``digits`` (1 to 15) decimals, rounded half-even from the exact binary value, of any double.

    The fraction is cut into eight 13-bit pieces, which covers every double that does not round to
    zero; multiplying by 10^digits runs from the lowest piece up in whole numbers, so nothing is lost."""
    d = _col(x)
    n = F.lit(digits) if isinstance(digits, int) else digits.cast("int")
    unit = F.rint(F.pow(F.lit(10.0), n)).cast("bigint")
    size = F.abs(d)
    fraction = F.try_mod(size, F.lit(1.0))
    whole = size - fraction
    base = 1 << 13

    def piece(i: Column) -> Column:
        scaled = fraction * F.pow(F.lit(float(base)), i + 1)
        return F.try_mod(scaled - F.try_mod(scaled, F.lit(1.0)), F.lit(float(base))).cast("bigint")

    def carry_up(state: Column, i: Column) -> Column:
        total = piece(i) * unit + F.shiftright(state["total"], 13)
        lost = state["lost"] | (state["total"].bitwiseAND(F.lit(base - 1)) != 0)
        return F.struct(total.alias("total"), lost.alias("lost"))

    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(False).alias("lost"))
    folded = F.aggregate(F.array(*[F.lit(i) for i in reversed(range(8))]), start, carry_up)

    def rounded(end: Column) -> Column:
        quotient = F.shiftright(end["total"], 13)
        left_over = end["total"].bitwiseAND(F.lit(base - 1))
        half = F.lit(base // 2)
        up = (left_over > half) | ((left_over == half) & (end["lost"] | (quotient % 2 == 1)))
        return quotient + F.when(up, 1).otherwise(0)

    sign = F.when(d.cast("string").startswith("-"), "-").otherwise("+")

    def text(fraction_units: Column) -> Column:
        carry = fraction_units >= unit
        # a number with a fraction is below 2^52, where one more is exact
        whole_text = whole_digits(whole + F.when(carry, 1.0).otherwise(0.0))
        frac_text = F.lpad(F.when(carry, F.lit(0)).otherwise(fraction_units).cast("string"), n, F.lit("0"))
        return F.concat(sign, whole_text, F.lit("."), frac_text)

    # no number has digits for these
    return F.when(F.isnan(d), "+nan").when(size == F.lit(float("inf")), F.concat(sign, F.lit("inf"))).otherwise(let(let(folded, rounded), text))

"""KPI formulas: reference extraction, compilation to instruction arrays, evaluation in the JVM.

A formula is text over numbers, operators, KPI references (``K12_3``) and input references (``I7``).
Compilation (Python ``ast``, once per distinct text in a batch) turns it into an array of small
instructions whose operands are positions of earlier instructions. Evaluation folds that array with
built-in higher-order functions, so the row path has no Python. NULL stands for "error"; it spreads
through every operation that uses it and ends as 0."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import let, signed_fixed
from ledgerloom.operators import formula_code
from ledgerloom.operators.formula_code import ANY_REF, KPI_REF, OPS

INSTRUCTION = "struct<op:int,a:int,b:int,c:int,num:double,ref:string>"


def compiled(formula: Column | str) -> Column:
    """Instruction array of a formula column. Meant for the definition table, not for value rows.

    The compiler travels to the executors by value, so they need no copy of this package."""
    cloudpickle.register_pickle_by_value(formula_code)
    return F.pandas_udf(formula_code.compile_batch, f"array<{INSTRUCTION}>")(formula)


def problems(formula: Column | str) -> Column:
    """Why a formula, or a part of it, counts as an error; NULL if all of it is understood."""
    cloudpickle.register_pickle_by_value(formula_code)
    return F.pandas_udf(lambda texts: texts.map(formula_code.problem), "string")(formula)


# --- references ---------------------------------------------------------------------------


def references(formula: Column | str, pattern: str = ANY_REF) -> Column:
    """All references in text order, repeats included."""
    f = F.col(formula) if isinstance(formula, str) else formula
    return F.regexp_extract_all(f, F.lit(f"({pattern})"), F.lit(1))


def kpi_of(ref: Column) -> Column:
    return F.substring_index(ref, "_", 1)


def ref_key(ref: Column) -> Column:
    """Key of a reference in normal form: leading zeros of a KPI's dim do not count."""
    dim = F.substring_index(ref, "_", -1).try_cast("decimal(38,0)").cast("string")
    return F.when(ref.startswith("K"), F.concat(kpi_of(ref), F.lit("_"), dim)).otherwise(ref)


def text_between(formula: Column | str) -> Column:
    """The text pieces around the references: one more piece than there are references."""
    return F.split(F.col(formula) if isinstance(formula, str) else formula, ANY_REF, -1)


def rejoined(between: Column, refs: Column, text_of_ref) -> Column:
    """Formula text with ``text_of_ref(ref)`` in place of each reference."""
    pieces = F.zip_with(between, refs, lambda p, r: F.concat(p, F.when(r.isNull(), "").otherwise(text_of_ref(r))))
    return F.array_join(pieces, "")


def substituted(formula: Column, text_of_ref) -> Column:
    return rejoined(text_between(formula), references(formula), text_of_ref)


# --- evaluation ---------------------------------------------------------------------------


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def _power(x: Column, y: Column) -> Column:
    raw = F.pow(x, y)
    undefined = (x == 0) & (y < 0)
    infinite_in = F.isnan(x) | F.isnan(y) | (F.abs(x) == float("inf")) | (F.abs(y) == float("inf"))
    broken = ~infinite_in & (F.isnan(raw) | (F.abs(raw) == float("inf")))
    return F.when(~undefined & ~broken, raw)


def _modulo(x: Column, y: Column) -> Column:
    rest = F.try_mod(x, y)
    return F.when((rest != 0) & ((rest < 0) != (y < 0)), rest + y).otherwise(rest)


def _round_to(x: Column, digits: Column) -> Column:
    """Rounded to decimals, or to tens, hundreds, ... for negative digits, halves to even.

    Up to 15 decimals the exact value of the double decides, beyond that the double product by the power of ten; a number
    whose product has no fraction any more is left as it is."""
    exact = signed_fixed(x, F.greatest(F.least(digits, F.lit(15.0)), F.lit(1.0))).try_cast("double")
    big = F.isnan(x) | (F.abs(x) == float("inf")) | ((digits >= 0) & (F.abs(x) >= float(2**52)))
    up, down = F.pow(F.lit(10.0), F.least(digits, F.lit(300.0))), F.pow(F.lit(10.0), F.least(-digits, F.lit(300.0)))
    fine = F.when(F.abs(x * up) < float(2**52), F.try_divide(F.rint(x * up), up)).otherwise(x)
    coarse = F.rint(F.try_divide(x, down)) * down
    return F.when(big, x).when(digits == 0, F.rint(x)).when(digits < 0, coarse).when(digits > 15, fine).otherwise(exact)


def placed(code: Column | str, place_of_ref) -> Column:
    """Instructions with the places of their references in ``a`` instead of their texts; one without a place (below 0) is the number 0.0."""

    def instruction(i: Column) -> Column:
        at = place_of_ref(i["ref"])
        is_ref = i["op"] == OPS["ref"]
        unknown = is_ref & (at < 0)
        return F.struct(
            F.when(unknown, OPS["num"]).otherwise(i["op"]).alias("op"), F.when(is_ref, at).otherwise(i["a"]).alias("a"),
            i["b"].alias("b"), i["c"].alias("c"), F.when(unknown, 0.0).otherwise(i["num"]).alias("num"),
        )

    return F.transform(code, instruction)


def evaluate(code: Column, value_of_ref, by_place: bool = False) -> Column:
    """Value of an instruction array; 0 on error, for a non-finite result or without a formula.

    ``value_of_ref(ref)`` gives operand values, by the reference's place if the code is ``placed``. The last check runs inside
    the fold, so the fold appears once in the plan. An operation is found by halving the operations that are left."""

    def ordered(test):
        # NaN compares false with everything here, unlike Spark's total order
        return lambda x, y: _flag(test(x, y) & ~F.isnan(x) & ~F.isnan(y))

    both = {
        "add": lambda x, y: x + y,
        "sub": lambda x, y: x - y,
        "mul": lambda x, y: x * y,
        "div": lambda x, y: F.try_divide(x, y),
        "pow": _power,
        "pow_text": lambda x, y: F.when(x < 0, -_power(-x, y)).otherwise(_power(x, y)),
        "mod": _modulo,
        "floordiv": lambda x, y: F.rint(F.try_divide(x - _modulo(x, y), y)),
        "min": lambda x, y: F.when(ordered(lambda p, q: q < p)(x, y) == 1.0, y).otherwise(x),
        "max": lambda x, y: F.when(ordered(lambda p, q: q > p)(x, y) == 1.0, y).otherwise(x),
        "lt": ordered(lambda x, y: x < y),
        "le": ordered(lambda x, y: x <= y),
        "gt": ordered(lambda x, y: x > y),
        "ge": ordered(lambda x, y: x >= y),
        "eq": ordered(lambda x, y: x == y),
        "ne": lambda x, y: F.lit(1.0) - ordered(lambda p, q: p == q)(x, y),
    }
    one = {
        "neg": lambda x: -x,
        "pos": lambda x: x,
        "not": lambda x: _flag(x == 0),
        "abs": lambda x: F.abs(x),
        "trunc": lambda x: F.when(~F.isnan(x) & (F.abs(x) != float("inf")), F.signum(x) * F.rint(F.abs(x) - F.try_mod(F.abs(x), F.lit(1.0)))),
        "round": lambda x: F.when(~F.isnan(x) & (F.abs(x) != float("inf")), F.rint(x)),
    }

    def on_struct(fn):
        return lambda v: fn(v["x"], v["y"])

    def pick(op: Column, cases: list[tuple[int, Column]]) -> Column:
        if len(cases) == 1:
            return cases[0][1]
        half = len(cases) // 2
        return F.when(op < cases[half][0], pick(op, cases[:half])).otherwise(pick(op, cases[half:]))

    def step(done: Column, ins: Column) -> Column:
        op = ins["op"]
        x, y, z = (F.get(done, ins[n]) for n in ("a", "b", "c"))
        plain = {"ref": value_of_ref(ins["a"] if by_place else ins["ref"]), "num": ins["num"]}
        plain |= {n: both[n](x, y) for n in ("mul", "add", "sub", "div")}
        # an error spreads to all that use it, except through a branch that is not taken
        branch = {
            "if": F.when(x != 0, y).when(x == 0, z),
            "and": F.when(x != 0, y).when(x == 0, x),
            "or": F.when(x != 0, x).when(x == 0, y),
        }
        # operations that name their operands often get them once
        pair, long_pair = x.isNotNull() & y.isNotNull(), ("pow", "pow_text", "mod", "floordiv")
        rare = {n: F.when(pair, fn(x, y)) for n, fn in both.items() if OPS[n] > OPS["error"] and n not in long_pair}
        both_once = F.struct(x.alias("x"), y.alias("y"))
        rare |= {n: F.when(pair, let(both_once, on_struct(both[n]))) for n in long_pair}
        single = {n: F.when(x.isNotNull(), let(x, fn)) for n, fn in one.items()}
        single["round_to"] = F.when(x.isNotNull(), let(x, lambda v: _round_to(v, ins["num"])))
        failed = {"error": F.lit(None).cast("double")}
        cases = {**plain, **branch, **failed, **rare, **single}
        value = pick(op, sorted(((OPS[n], v.cast("double")) for n, v in cases.items()), key=lambda c: c[0]))
        return F.array_append(done, value)

    def finish(done: Column) -> Column:
        result = F.try_element_at(done, F.lit(-1))
        usable = result.isNotNull() & ~F.isnan(result) & (F.abs(result) != F.lit(float("inf")))
        return F.when(usable, result).otherwise(F.lit(0.0))

    folded = F.aggregate(code, F.array().cast("array<double>"), step, finish)
    return F.coalesce(folded, F.lit(0.0))

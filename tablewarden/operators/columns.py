"""Operators over whole tables that keep the number of rows, or drop rows by what they hold."""

from __future__ import annotations

import ast
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, NumericType, StringType, StructType

from ..functions.values import coerce
from .selection import quantiles


def flatten(df: DataFrame, sep: str = "__", depth: int = 10) -> DataFrame:
    """Structs to parent__child columns, arrays to parent__0, parent__1 and so on.

    An array's width is its longest, found by one aggregate over all array columns, whatever it is. Of two columns
    of one name the first stays. Maps stay as they are.
    """
    for _ in range(depth):
        arrays = [f.name for f in df.schema if isinstance(f.dataType, ArrayType)]
        widths = df.agg(*[F.max(F.size(F.col(f"`{c}`"))).alias(c) for c in arrays]).first().asDict() if arrays else {}
        out: dict[str, Column] = {}
        again = False
        for f in df.schema:
            c = F.col(f"`{f.name}`")
            if isinstance(f.dataType, StructType):
                again = True
                for x in f.dataType.names:
                    out.setdefault(f"{f.name}{sep}{x}", c.getField(x))
            elif isinstance(f.dataType, ArrayType):
                again = True
                for i in range(widths[f.name] or 0):
                    out.setdefault(f"{f.name}{sep}{i}", F.get(c, F.lit(i)))
            else:
                out.setdefault(f.name, c)
        if not again:
            break
        df = df.select(*[c.alias(n) for n, c in out.items()])
    return df


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Names that the table does not have are passed over."""
    return df.withColumnsRenamed(mapping)


def coerce_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: coerce(F.col(c), t) for c, t in types.items() if c in df.columns})


def coercion_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """column, failures: values that are not null and become null. One pass."""
    counts = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNotNull() & coerce(F.col(c), t).isNull()).alias("failures")) for c, t in types.items() if c in df.columns]
    return df.agg(F.array(*counts).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def cast_whole(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts a column only if all of its values can be cast."""
    there = {c: t for c, t in types.items() if c in df.columns}
    if not there:
        return df
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull()).alias(c) for c, t in there.items()]).first()
    return df.withColumns({c: F.col(c).cast("string").try_cast(t) for c, t in there.items() if not bad[c]})


def fill_nulls(df: DataFrame, values: dict | None = None) -> DataFrame:
    """The given values, or empty texts and zeros."""
    if values is not None:
        return df.fillna({c: v for c, v in values.items() if c in df.columns})
    return df.fillna("").fillna(0)


def fill_statistic(df: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """mean or median (of the whole table) for nulls in numeric columns; others are left alone."""
    cols = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, NumericType)]
    if not cols:
        return df
    if how == "median":
        one = {c: q[0] for c, q in quantiles(df, cols, [0.5]).items()}
    else:
        one = df.agg(*[{"mean": F.avg}[how](F.col(f"`{c}`")).alias(c) for c in cols]).first()
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(one[c])) for c in cols})


_BINARY = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*", ast.Div: "/", ast.Mod: "%"}
_COMPARE: dict[type, Callable[[Column, Column], Column]] = {ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b}


def expression(text: str, columns: Sequence[str]) -> Column:
    """Arithmetic, comparisons, and / or / not, a if c else b, in (...) over column names and constants; all else is refused."""

    def build(n: ast.expr) -> Column:
        match n:
            case ast.Constant(value=bool() | int() | float() | str() | None):
                return F.lit(n.value)
            case ast.Name() if n.id in columns:
                return F.col(n.id)
            case ast.BinOp(op=ast.FloorDiv()):
                return F.floor(build(n.left) / F.when(build(n.right) != 0, build(n.right)))
            case ast.BinOp(op=ast.Pow()):
                return F.pow(build(n.left), build(n.right))
            case ast.BinOp(op=ast.Div()):
                return build(n.left) / F.when(build(n.right) != 0, build(n.right))
            case ast.BinOp() if type(n.op) in _BINARY:
                a, b = build(n.left), build(n.right)
                return {"+": a + b, "-": a - b, "*": a * b, "%": a % F.when(b != 0, b)}[_BINARY[type(n.op)]]
            case ast.UnaryOp(op=ast.USub()):
                return -build(n.operand)
            case ast.UnaryOp(op=ast.Not()):
                return ~build(n.operand)
            case ast.BoolOp():
                out = build(n.values[0])
                for v in n.values[1:]:
                    out = out & build(v) if isinstance(n.op, ast.And) else out | build(v)
                return out
            case ast.Compare(ops=[ast.In() | ast.NotIn() as op], comparators=[ast.List() | ast.Tuple() as items]):
                found = build(n.left).isin(*[build(x) for x in items.elts])
                return found if isinstance(op, ast.In) else ~found
            case ast.Compare():
                out, left = None, build(n.left)
                for op, right in zip(n.ops, n.comparators, strict=True):
                    if type(op) not in _COMPARE:
                        break
                    right = build(right)
                    one = _COMPARE[type(op)](left, right)
                    out, left = one if out is None else out & one, right
                else:
                    return out
            case ast.IfExp():
                return F.when(build(n.test), build(n.body)).otherwise(build(n.orelse))
        raise ValueError(f"not allowed in a derived column: {ast.dump(n)[:80]}")

    return build(ast.parse(text, mode="eval").body)


def derive(df: DataFrame, name: str, text: str) -> DataFrame:
    return df.withColumn(name, expression(text, df.columns))


def stamp(df: DataFrame, run_id: str, loaded_at: str) -> DataFrame:
    """_pipeline_id and _loaded_at_utc, one value for the run."""
    return df.withColumns({"_pipeline_id": F.lit(run_id), "_loaded_at_utc": F.lit(loaded_at)})


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def null_cells(df: DataFrame) -> DataFrame:
    """column, nulls: in one pass."""
    counts = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"`{c}`").isNull()).alias("nulls")) for c in df.columns]
    return df.agg(F.array(*counts).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def nested_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (StructType, ArrayType, MapType))]

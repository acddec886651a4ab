"""Helpers that write DuckDB SQL for the correctness oracle.

Only the oracle side needs them: Spark's ``hash()`` is Murmur3 x86_32 with
seed 42, which DuckDB does not have, so the oracle rebuilds it for BIGINT and
text keys with integer arithmetic in a chain of sub-queries (each step a column,
so no expression is repeated).
"""

from __future__ import annotations

# Fixed values of Murmur3 x86_32 (public algorithm constants) and Spark's seed.
_C1 = 3432918353        # 0xcc9e2d51
_C2 = 461845907         # 0x1b873593
_F1 = 2246822507        # 0x85ebca6b
_F2 = 3266489909        # 0xc2b2ae35
_N = 3864292196         # 0xe6546b64
_SEED = 42
_M32 = 4294967295


def _mul(a: str, k: int) -> str:
    return f"(((({a})::HUGEINT * {k}) % 4294967296)::UBIGINT)"


def _rot(a: str, r: int) -> str:
    return f"(((({a}) << {r}) & {_M32}) | (({a}) >> {32 - r}))"


def spark_hash_long(src: str, key: str, out: str) -> str:
    """Wrap relation ``src`` adding ``out`` = Spark ``hash(key)`` for a BIGINT key."""
    steps = [
        ("__w0", f"((({key})::BIGINT) & {_M32})::UBIGINT"),
        ("__w1", f"(((({key})::BIGINT) >> 32) & {_M32})::UBIGINT"),
        ("__h", f"{_SEED}::UBIGINT"),
    ]
    for w in ("__w0", "__w1"):
        steps.append(("__k", _mul(_rot(_mul(w, _C1), 15), _C2)))
        steps.append(("__h", "xor(__h, __k)"))
        steps.append(("__h", f"((({_rot('__h', 13)}) * 5 + {_N}) & {_M32})"))
    return _finish_hash(src, steps, "8", out)


def spark_hash_text(src: str, key: str, out: str) -> str:
    """Wrap relation ``src`` adding ``out`` = Spark ``hash(key)`` for an ASCII text key: whole 4-byte
    little-endian words, then single bytes, folded by ``list_reduce`` (a step refers to the state twice,
    so a chain of sub-queries would double with every word)."""
    def byte(i: str) -> str:
        return f"ascii(substr({key}, ({i} + 1)::BIGINT, 1))::UBIGINT"

    whole = " + ".join(f"{byte(f'4 * i + {n}')} * {256 ** n}" for n in range(4))
    words = (f"list_concat(list_transform(range(length({key}) // 4), lambda i: ({whole})::UBIGINT), "
             f"list_transform(range(length({key}) // 4 * 4, length({key})), lambda i: ({byte('i')})::UBIGINT))")
    mixed = f"list_transform({words}, lambda w: ({_mul(_rot(_mul('w', _C1), 15), _C2)})::UBIGINT)"
    folded = (f"list_reduce(list_prepend({_SEED}::UBIGINT, {mixed}), "
              f"lambda h, k: ((({_rot('xor(h, k)', 13)}) * 5 + {_N}) & {_M32})::UBIGINT)")
    return _finish_hash(src, [("__h", folded)], f"length({key})", out)


def _finish_hash(src: str, steps: list, length: str, out: str) -> str:
    steps.append(("__h", f"xor(__h, ({length})::UBIGINT)"))
    steps.append(("__h", _mul("xor(__h, __h >> 16)", _F1)))
    steps.append(("__h", _mul("xor(__h, __h >> 13)", _F2)))
    steps.append(("__h", "xor(__h, __h >> 16)"))
    steps.append((out, "(CASE WHEN __h >= 2147483648 THEN __h::BIGINT - 4294967296 ELSE __h::BIGINT END)::INTEGER"))
    sql = f"SELECT *, NULL::UBIGINT AS __w0, NULL::UBIGINT AS __w1, NULL::UBIGINT AS __h, NULL::UBIGINT AS __k FROM ({src}) _s"
    for i, (col, expr) in enumerate(steps):
        if col == out:
            sql = f"SELECT * EXCLUDE (__w0, __w1, __h, __k), {expr} AS {out} FROM ({sql}) _m{i}"
        else:
            sql = f"SELECT * REPLACE ({expr} AS {col}) FROM ({sql}) _m{i}"
    return sql


def split_label_sql(hash_col: str) -> str:
    """The three-way split of a hash column (bucket via bigint abs, see X10)."""
    b = f"(abs({hash_col}::BIGINT) % 10)"
    return f"CASE WHEN {b} < 8 THEN 'train' WHEN {b} = 8 THEN 'val' ELSE 'test' END"

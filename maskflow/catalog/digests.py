"""SHA-512 in plain SQL, for a database that lacks it: 64-bit words as UBIGINT."""

from __future__ import annotations

from functools import reduce

WORD = 1 << 64


def _primes(n: int) -> list[int]:
    found: list[int] = []
    number = 2
    while len(found) < n:
        if all(number % p for p in found):
            found.append(number)
        number += 1
    return found


def _root_bits(number: int, degree: int) -> int:
    """First 64 bits behind the point of the square or cube root."""
    low, high = 0, 1 << 80
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**degree <= number << 64 * degree else (low, middle - 1)
    return low % WORD


START = [_root_bits(p, 2) for p in _primes(8)]
ROUND = [_root_bits(p, 3) for p in _primes(80)]


def _add(*words: str) -> str:
    total = " + ".join(f"({word})::UHUGEINT" for word in words)
    return f"(({total}) % {WORD}::UHUGEINT)::UBIGINT"


def _turn(word: str, n: int) -> str:
    """Rotated right: the low n bits move to the top."""
    return f"(({word} % {1 << n}::UBIGINT) * {1 << (64 - n)}::UBIGINT + {word} // {1 << n}::UBIGINT)"


def _xor(*words: str) -> str:
    return reduce(lambda a, b: f"xor({a}, {b})", words)


def _mixed(word: str, a: int, b: int, shift: int) -> str:
    return _xor(_turn(word, a), _turn(word, b), f"({word} // {1 << shift}::UBIGINT)")


def _summed(word: str, a: int, b: int, c: int) -> str:
    return _xor(_turn(word, a), _turn(word, b), _turn(word, c))


def _list(words: list[int]) -> str:
    return "[" + ", ".join(f"{word}::UBIGINT" for word in words) + "]"


def sql_sha512(values: str) -> str:
    """CTEs ending in ``sha512s(raw, digest)`` for texts of at most 111 bytes, which
    ``values`` selects as ``value``: one block, a recursion step per schedule word
    and per round."""
    data = "lower(hex(encode(value)))"
    size = "octet_length(encode(value))"
    block = f"rpad({data} || '80', 224, '0') || printf('%032x', CAST({size} * 8 AS BIGINT))"
    new = _add(
        "w[t - 16]", _mixed("w[t - 15]", 1, 8, 7), "w[t - 7]", _mixed("w[t - 2]", 19, 61, 6)
    )
    choice = f"xor(s[5] & s[6], xor(s[5], {WORD - 1}::UBIGINT) & s[7])"
    first = _add("s[8]", _summed("s[5]", 14, 18, 41), choice, f"{_list(ROUND)}[t]", "w[t]")
    most = "xor(xor(s[1] & s[2], s[1] & s[3]), s[2] & s[3])"
    second = _add(_summed("s[1]", 28, 34, 39), most)
    state = f"[{_add('one', 'two')}, s[1], s[2], s[3], {_add('s[4]', 'one')}, s[5], s[6], s[7]]"
    words = ", ".join(f"('0x' || substr(block, {16 * k + 1}, 16))::UBIGINT" for k in range(16))
    total = " || ".join(
        f"printf('%016x', {_add(f's[{k + 1}]', f'{word}::UBIGINT')})" for k, word in enumerate(START)
    )
    return f"""
    blocks AS (
        SELECT value, {block} AS block
        FROM (SELECT DISTINCT value FROM ({values}) WHERE value IS NOT NULL)),
    schedules AS (
        SELECT value, 17 AS t, [{words}] AS w FROM blocks
        UNION ALL
        SELECT value, t + 1, list_append(w, {new}) FROM schedules WHERE t <= 80),
    turns AS (
        SELECT value, 1 AS t, w, {_list(START)} AS s FROM schedules WHERE t = 81
        UNION ALL
        SELECT value, t + 1, w, {state}
        FROM (SELECT *, {first} AS one, {second} AS two FROM turns WHERE t <= 80)),
    sha512s AS (SELECT value AS raw, {total} AS digest FROM turns WHERE t = 81)
    """

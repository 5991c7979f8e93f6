"""Python-side reading of the small literals found in queries: durations, integers, windows, matcher fragments."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

from spanlake.plans.queries import LabelMatcher, MatchOp, UnsupportedQuery

# Nanoseconds per duration unit; a bare number is milliseconds.
DURATION_UNITS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}

# Seconds per window unit.
WINDOW_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400}

# Matcher fragments look like  label OP "value".
FRAGMENT = re.compile(r'(\w+)\s*(=~|!=|!~|=)\s*"(.*)"', re.DOTALL | re.ASCII)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "v": "\v", "b": "\b", "f": "\f"}

_NUMBER = re.compile(r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*", re.ASCII)


def duration_ns(text: str) -> int:
    """``100ms`` / ``5s`` / ``2.5m`` in nanoseconds, rounded; malformed text is 0."""
    match = re.fullmatch(r"([0-9.]+)\s*(ns|us|µs|ms|s|m|h)?", text.strip())
    if match is None:
        return 0
    # a number with several dots counts up to the second one
    number = re.match(r"\d*\.?\d*", match[1])[0]
    if number in ("", "."):
        return 0
    nanos = Decimal(number) * DURATION_UNITS[match[2] or "ms"]
    return int(nanos.to_integral_value(ROUND_HALF_UP))


def integer(text: str) -> int:
    """A numeric literal truncated towards zero; anything else is 0."""
    return int(Decimal(text.strip())) if _NUMBER.fullmatch(text) else 0


def window_seconds(window: str, default: int) -> int:
    match = re.fullmatch(r"([0-9]+)([smhd])", window)
    return int(match[1]) * WINDOW_UNITS[match[2]] if match else default


def matcher_fragment(fragment: str) -> LabelMatcher:
    match = FRAGMENT.fullmatch(fragment.strip())
    if match is None:
        raise UnsupportedQuery(f"cannot read the matcher: {fragment}")
    return LabelMatcher(match[1], MatchOp(match[2]), _unescape(match[3]))


def _unescape(text: str) -> str:
    """C-style escapes: ``\\n``, ``\\x41``, ``\\101``; any other escaped character stands for itself."""

    def character(match: re.Match[str]) -> str:
        code = match[1]
        if len(code) > 1 and code[0] == "x":
            return chr(int(code[1:], 16))
        if code[0] in "01234567":
            return chr(int(code, 8) & 0xFF)
        return ESCAPES.get(code, code)

    return re.sub(r"\\(x[0-9a-fA-F]{1,2}|[0-7]{1,3}|.)", character, text, flags=re.DOTALL)

"""Translation of configured regular expressions to the dialect Spark runs.

Rules are written for Python's `re` on non-Unicode classes. Spark evaluates
Java patterns, so the few constructs that differ are rewritten here, once, on
the driver; a pattern that cannot be carried over raises.
"""

from __future__ import annotations

import re
import warnings

from ..model import ConfigError

# Characters Python strips as white space, as the inside of a character class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_QUANTIFIER = re.compile(r"\{(\d*)(,?)(\d*)\}")
_INLINE_FLAGS = re.compile(r"\(\?([a-zA-Z]+)([:)])")
# Escapes with another meaning in Java.
_ESCAPES = {"Z": r"\z", "v": r"\x0B", "0": r"\x00"}


def _checked(expression: str) -> re.Pattern[str]:
    try:
        with warnings.catch_warnings():  # of class syntax that is escaped below
            warnings.simplefilter("ignore", FutureWarning)
            return re.compile(expression)
    except (re.error, RecursionError, OverflowError) as err:
        raise ConfigError(f"invalid regular expression {expression!r}: {err}") from err


def can_be_empty(expression: str) -> bool:
    """Whether a match of the expression may hold no character."""
    _checked(expression)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", FutureWarning)
        return re._parser.parse(expression).getwidth()[0] == 0


def java_regex(expression: str) -> str:
    """`expression` for `rlike`, `regexp_replace` and friends.

    The `(?d)` prefix makes `\\n` the only line terminator, as it is in Python:
    carriage returns survive inside records.
    """
    names = _checked(expression).groupindex
    out, i, n = ["(?d)"], 0, len(expression)
    while i < n:
        ch = expression[i]
        if ch == "\\":
            nxt = expression[i + 1]
            out.append(_ESCAPES.get(nxt, ch + nxt))
            i += 2
        elif ch == "[":
            text, i = _char_class(expression, i)
            out.append(text)
        elif expression.startswith("(?P<", i):
            end = expression.index(">", i)
            out.append(f"(?<g{names[expression[i + 4:end]]}>")
            i = end + 1
        elif expression.startswith("(?P=", i):
            end = expression.index(")", i)
            out.append(rf"\k<g{names[expression[i + 4:end]]}>")
            i = end + 1
        elif expression.startswith("(?(", i):
            raise ConfigError(f"conditional groups are not supported: {expression!r}")
        elif (flags := _INLINE_FLAGS.match(expression, i)) is not None:
            if set(flags.group(1)) - set("imsx"):
                raise ConfigError(f"inline flags '{flags.group(1)}' are not supported: {expression!r}")
            out.append(flags.group(0))
            i = flags.end()
        elif ch == "{":
            quantifier = _QUANTIFIER.match(expression, i)
            if quantifier and (quantifier.group(1) or quantifier.group(3)):
                low, comma, high = quantifier.groups()
                out.append("{" + (low or "0") + comma + high + "}")
                i = quantifier.end()
            else:
                out.append(r"\{")
                i += 1
        else:
            out.append(ch)
            i += 1
    return "".join(out)


def _char_class(expression: str, start: int) -> tuple[str, int]:
    """One `[...]` with the characters that nest or intersect in Java escaped."""
    out, i = ["["], start + 1
    if expression[i] == "^":
        out.append("^")
        i += 1
    first = i
    while i == first or expression[i] != "]":
        ch = expression[i]
        if ch == "\\":
            nxt = expression[i + 1]
            out.append(_ESCAPES.get(nxt, ch + nxt) if nxt != "Z" else "Z")
            i += 2
            continue
        out.append("\\" + ch if ch in "[]&^" else ch)
        i += 1
    return "".join(out) + "]", i + 1


def anchored(expression: str) -> str:
    """Match at the start of the text only, as a field pattern does."""
    return r"\A(?:" + java_regex(expression) + ")"


_TEMPLATE = re.compile(r"\\(?:g<(\w+)>|(\d{1,2})|(.))", re.DOTALL)
_CONTROL = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "f": "\f", "v": "\v", "b": "\b", "\\": "\\"}


def java_replacement(template: str, expression: str) -> str:
    """Replacement text with `\\1` / `\\g<name>` references, in Java's `$1` form."""
    pattern = _checked(expression)

    def literal(text: str) -> str:
        return text.replace("\\", r"\\").replace("$", r"\$")

    out, position, after_group = [], 0, False
    pieces: list[tuple[bool, str]] = []
    for match in _TEMPLATE.finditer(template):
        pieces.append((False, template[position:match.start()]))
        position = match.end()
        name, number, other = match.groups()
        if other is not None:
            pieces.append((False, _CONTROL.get(other, "\\" + other)))
            continue
        group = number if number is not None else name
        index = int(group) if group.isdigit() else pattern.groupindex.get(group, -1)
        if not 0 <= index <= pattern.groups:
            raise ConfigError(f"no group {group!r} in {expression!r}")
        pieces.append((True, str(index)))
    pieces.append((False, template[position:]))
    for is_group, text in pieces:
        if is_group:
            out.append("$" + text)
        elif text:
            # A digit right after a reference would be read as part of it.
            out.append(("\\" if after_group and text[0].isdigit() else "") + literal(text))
        after_group = is_group or (after_group and not text)
    return "".join(out)

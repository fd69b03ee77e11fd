r"""One meaning of a pattern in both engines: Python's, spelled out for Java.

Patterns of this library are written for Python's `re`, where `\s`, `\w`, `\d`, `\b`, `.`,
`$` and the folding of case know all of Unicode. Java's know ASCII, or, asked to, another
notion of it. `java` reads a pattern and writes one in which each of these is an explicit
class or look-around, so that Spark's regular expressions find what Python's would.

Groups, alternatives, repeats and look-arounds are alike in both and stay. Flags may stand
at the head of a pattern (i, s and m); scoped flags, back references, conditionals and
named characters are refused, since nothing here needs them.
"""

from __future__ import annotations

import re
import sys
from functools import lru_cache
from typing import NamedTuple

#: Python's white space, digits and word characters as contents of a Java class.
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
DIGIT = r"\p{Nd}"
WORD = r"\p{L}\p{N}_"
_CLASS = {"s": SPACE, "d": DIGIT, "w": WORD}
_BETWEEN = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
_WITHIN = f"(?:(?<=[{WORD}])(?=[{WORD}])|(?<![{WORD}])(?![{WORD}]))"
_CONTROL = {"t": "\t", "n": "\n", "r": "\r", "f": "\f", "v": "\v", "a": "\a", "0": "\0"}


class Token(NamedTuple):
    """A piece of a pattern. kind: char, class (s, d, w or their negations), set, any, place, open, close, or, repeat."""

    kind: str
    value: object
    negated: bool = False


def _escape(pattern: str, i: int, inside: bool) -> tuple[Token, int]:
    c = pattern[i]
    if c.lower() in _CLASS:
        return Token("class", c.lower(), c.isupper()), i + 1
    if c in "xuU" and (width := {"x": 2, "u": 4, "U": 8}[c]):
        return Token("char", chr(int(pattern[i + 1 : i + 1 + width], 16))), i + 1 + width
    if inside and c == "b":
        return Token("char", "\b"), i + 1
    if c in _CONTROL and not pattern[i : i + 2].isdigit():
        return Token("char", _CONTROL[c]), i + 1
    if not inside and c in "bBAZ":
        return Token("place", c), i + 1
    if c.isalnum():
        raise ValueError(f"\\{c} is not known in {pattern!r}")
    return Token("char", c), i + 1


def _set(pattern: str, i: int) -> tuple[Token, int]:
    """A bracketed class from behind its bracket: characters, (first, last) pairs and class tokens."""
    items: list = []
    negated = pattern[i] == "^"
    i += negated
    begin = i
    while pattern[i] != "]" or i == begin:
        if pattern[i] == "\\":
            one, i = _escape(pattern, i + 1, True)
        else:
            one, i = Token("char", pattern[i]), i + 1
        if one.kind == "char" and pattern[i] == "-" and pattern[i + 1] != "]":
            last, i = _escape(pattern, i + 2, True) if pattern[i + 1] == "\\" else (Token("char", pattern[i + 1]), i + 2)
            items.append((one.value, last.value))
        else:
            items.append(one if one.kind == "class" else one.value)
    return Token("set", items, negated), i + 1


_FLAGS = re.compile(r"\(\?([a-zA-Z]+)\)")
_GROUP = re.compile(r"\((?:\?(?:[:=!>]|<[=!]))?(?!\?)")
_REPEAT = re.compile(r"(?:[*+?]|\{[0-9]+(?:,[0-9]*)?\}|\{,[0-9]+\})[?+]?")


def tokens(pattern: str) -> tuple[list[Token], str]:
    """(pieces of a pattern, flags at its head)."""
    head = _FLAGS.match(pattern)
    flags, i = (head[1], head.end()) if head else ("", 0)
    if set(flags) - set("ism"):
        raise ValueError(f"flags of {pattern!r}")
    out: list[Token] = []
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            one, i = _escape(pattern, i + 1, False)
        elif c == "[":
            one, i = _set(pattern, i + 1)
        elif c == "(":
            group = _GROUP.match(pattern, i)
            if not group:
                raise ValueError(f"group of {pattern!r} at {i}")
            one, i = Token("open", group[0]), group.end()
        elif c in ")|.^$":
            one, i = Token({")": "close", "|": "or", ".": "any"}.get(c, "place"), c), i + 1
        elif repeat := _REPEAT.match(pattern, i):
            one, i = Token("repeat", repeat[0]), repeat.end()
        else:
            one, i = Token("char", c), i + 1
        out.append(one)
    return out, flags


@lru_cache(maxsize=1)
def _every_character() -> str:
    return "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)


@lru_cache(maxsize=None)
def cases(c: str) -> tuple[str, ...]:
    """The characters that Python takes for c when case plays no part."""
    if c.isascii() and not c.isalpha():
        return (c,)
    return tuple(re.findall(re.escape(c), _every_character(), re.IGNORECASE))


def _literal(c: str) -> str:
    if c.isascii() and c.isalnum():
        return c
    return f"\\{c}" if c.isascii() and c.isprintable() and c != " " else f"\\x{{{ord(c):x}}}"


def _content(items: list, fold: bool) -> str:
    """What stands between the brackets of a Java class."""
    out = []
    for item in items:
        if isinstance(item, Token):
            inner = _CLASS[item.value]
            out.append(f"[^{inner}]" if item.negated else inner)
        elif isinstance(item, tuple):
            first, last = item
            out.append(f"{_literal(first)}-{_literal(last)}")
            if fold:
                own = map(chr, range(ord(first), ord(last) + 1))
                out += [_literal(x) for x in sorted({x for c in own for x in cases(c)} - {*map(chr, range(ord(first), ord(last) + 1))})]
        else:
            out += [_literal(x) for x in (cases(item) if fold else (item,))]
    return "".join(out)


def _is_word(token: Token | None) -> bool | None:
    """Whether what a piece matches is surely a word character, or surely none."""
    if token is None:
        return None
    if token.kind == "char":
        return token.value.isalnum() or token.value == "_"
    if token.kind == "class":
        return None if token.negated else token.value != "s"
    if token.kind == "set" and not token.negated:
        known = {_is_word(x if isinstance(x, Token) else Token("char", x)) if not isinstance(x, tuple) else (True if x in (("a", "z"), ("A", "Z"), ("0", "9")) else None) for x in token.value}
        return known.pop() if len(known) == 1 else None
    return None


def _least(repeat: str) -> int:
    return {"*": 0, "?": 0, "+": 1}.get(repeat[0], 0 if repeat[1:2] in ",0" else 1)


def _most(repeat: str) -> int | None:
    if repeat[0] in "*+?":
        return 1 if repeat[0] == "?" else None
    last = repeat[1 : repeat.index("}")].split(",")[-1]
    return int(last) if last else None


def _place(value: str, before: Token | None, after: Token | None, first: str, many: bool) -> str:
    """A place as a look-around; the shortest that says it, given what stands on its sides."""
    if value == "b":
        if _is_word(after) is True:  # the character itself is looked at first: that is cheap and mostly enough
            return f"(?={first})(?<![{WORD}])"
        if _is_word(before) is True:
            return f"(?![{WORD}])"
        return f"(?<=[{WORD}])" if _is_word(after) is False else f"(?=[{WORD}])" if _is_word(before) is False else _BETWEEN
    if value == "^" and many:
        return r"(?<![^\n])"
    if value == "$":
        return r"(?![^\n])" if many else r"(?=\n?\z)"
    return {"B": _WITHIN, "A": r"\A", "^": r"\A", "Z": r"\z"}[value]


@lru_cache(maxsize=4096)
def java(pattern: str, ignore_case: bool = False) -> str:
    """A Java pattern that finds what a Python pattern finds."""
    own, flags = tokens(pattern)
    fold = ignore_case or "i" in flags

    def written(token: Token) -> str:
        if token.kind == "char":
            same = cases(token.value) if fold else (token.value,)
            return _literal(same[0]) if len(same) == 1 else f"[{''.join(map(_literal, same))}]"
        if token.kind == "class":
            return f"[{'^' if token.negated else ''}{_CLASS[token.value]}]"
        if token.kind == "set":
            inner = f"[{_content(token.value, fold)}]"
            return f"(?:(?!{inner})(?s:.))" if token.negated else inner  # Java's negation of nested classes is another one
        if token.kind == "any":
            return "(?s:.)" if "s" in flags else r"[^\n]"
        if token.kind == "repeat" and token.value.startswith("{,"):
            return "{0" + token.value[1:]
        return str(token.value)

    out = []
    for k, token in enumerate(own):
        if token.kind != "place":
            out.append(written(token))
            continue
        before = own[k - 1] if k else None
        if before is not None and before.kind == "repeat":
            before = own[k - 2] if _least(before.value) else None
        after = own[k + 1] if k + 1 < len(own) else None
        if k + 2 < len(own) and own[k + 2].kind == "repeat" and not _least(own[k + 2].value):
            after = None
        out.append(_place(token.value, before, after, written(after) if after is not None else "", "m" in flags))
    return "".join(out)


def any_of(patterns: list[str], ignore_case: bool = True) -> str:
    """A Java pattern that finds what any of some Python patterns finds."""
    return "|".join(f"(?:{java(p, ignore_case)})" for p in patterns)


def literal(pattern: str) -> str:
    """The longest run of characters that every match of a pattern has, in lower case; empty if none is sure."""
    own, _ = tokens(pattern)
    if any(t.kind == "or" and _depth(own, k) == 0 for k, t in enumerate(own)):
        return ""
    best = run = ""
    for k, token in enumerate(own):
        follows = own[k + 1] if k + 1 < len(own) else None
        plain = token.kind == "char" and _depth(own, k) == 0
        if plain and not (follows is not None and follows.kind == "repeat"):
            run += token.value
        elif token.kind != "place" or _depth(own, k):
            run = ""
        best = max(best, run, key=len)
    return best.lower()


def _depth(own: list[Token], k: int) -> int:
    return sum((t.kind == "open") - (t.kind == "close") for t in own[: k + 1])


def width(pattern: str) -> int | None:
    """Characters that a match has at most; None if there is no bound."""
    own, _ = tokens(pattern)

    def alternatives(k: int) -> tuple[int | None, int]:
        """(the widest of the alternatives from k on, where their group ends)."""
        best: int | None = 0
        total: int | None = 0
        while k < len(own) and own[k].kind != "close":
            token, size = own[k], 0
            if token.kind == "or":
                best = None if best is None or total is None else max(best, total)
                total, k = 0, k + 1
                continue
            if token.kind == "open":
                size, k = alternatives(k + 1)
                if "=" in token.value or "!" in token.value:
                    size = 0
            elif token.kind in ("char", "class", "set", "any"):
                size = 1
            if k + 1 < len(own) and own[k + 1].kind == "repeat":
                k += 1
                bound = _most(own[k].value)
                size = None if bound is None or size is None else size * bound
            total = None if total is None or size is None else total + size
            k += 1
        return (None if best is None or total is None else max(best, total)), k

    return alternatives(0)[0]

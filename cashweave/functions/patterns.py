"""Rule patterns in the advanced POSIX syntax, as Java patterns.

Rule tables are written for a database whose patterns know bracket classes such as
``[[:alpha:]]``, word edges ``\\m``, ``\\M``, ``\\y``, and escapes that Java reads otherwise
or not at all. What has no Java form raises, naming the pattern, instead of matching
something else.
"""

from __future__ import annotations

import re

# Names of classes in brackets, and escapes of one letter.
_CLASSES = {
    "alpha": r"\p{IsAlphabetic}",
    "digit": r"\p{IsDigit}",
    "alnum": r"\p{IsAlphabetic}\p{IsDigit}",
    "upper": r"\p{IsUppercase}",
    "lower": r"\p{IsLowercase}",
    "space": r"\p{IsWhite_Space}",
    "blank": r" \t",
    "punct": r"\p{IsPunctuation}$+<=>^`|~",
    "cntrl": r"\p{Cntrl}",
    "graph": r"\p{Graph}",
    "print": r"\p{Print}",
    "xdigit": "0-9A-Fa-f",
    "word": r"\p{IsAlphabetic}\p{IsDigit}_",
}
_WORD_BEGIN, _WORD_END = r"(?<!\w)(?=\w)", r"(?<=\w)(?!\w)"
_ESCAPES = {
    "m": _WORD_BEGIN,
    "M": _WORD_END,
    "y": r"\b",
    "Y": r"\B",
    "A": r"\A",
    "Z": r"\z",
    "B": r"\\",
    "b": r"\x08",
    "v": r"\x0B",
    "a": r"\x07",
    "e": r"\x1B",
    **{c: f"\\{c}" for c in "dwsDWSntrf"},
}
# In brackets these are classes; word edges and complements are not allowed there.
_IN_BRACKETS = {c: _ESCAPES[c] for c in "dwsntrfbvaeB"}


class PatternError(ValueError):
    """A pattern that has no Java form."""


class _Reader:
    def __init__(self, pattern: str) -> None:
        self.pattern, self.at = pattern, 0

    def error(self, what: str) -> PatternError:
        return PatternError(f"pattern {self.pattern!r}: {what}")

    def take(self, shape: str) -> str | None:
        found = re.compile(shape, re.DOTALL).match(self.pattern, self.at)
        if found is None:
            return None
        self.at = found.end()
        return found[0]

    def code(self) -> str | None:
        """An escape by number."""
        for shape, digits in ((r"u[0-9A-Fa-f]{4}", 1), (r"U[0-9A-Fa-f]{8}", 1), (r"x[0-9A-Fa-f]+", 1)):
            found = self.take(shape)
            if found:
                number = int(found[digits:], 16)
                if number > 0x10FFFF:
                    raise self.error(f"no character has the number {found[digits:]}")
                return f"\\x{{{number:X}}}"
        return None

    def escape(self, known: dict[str, str]) -> str:
        code = self.code()
        if code is not None:
            return code
        letter = self.take(".")
        if letter is None:
            raise self.error("ends with a backslash")
        if letter in known:
            return known[letter]
        if letter.isalnum():
            raise self.error(f"\\{letter} has no equal here")
        return re.escape(letter)

    def bracket(self) -> str:
        """After ``[``: the rest of a bracket expression."""
        out = ["[", self.take(r"\^") or ""]
        if self.take("]"):  # in the first place it is a letter
            out.append(r"\]")
        while True:
            named = self.take(r"\[:\w*:\]")
            if named:
                if named[2:-2] not in _CLASSES:
                    raise self.error(f"no class {named}")
                out.append(_CLASSES[named[2:-2]])
            elif self.take(r"\[[.=]"):
                raise self.error("collating elements have no equal in Java")
            elif self.take("]"):
                return "".join([*out, "]"])
            elif self.take(r"\\"):
                out.append(self.escape(_IN_BRACKETS))
            else:
                letter = self.take(".")
                if letter is None:
                    raise self.error("a bracket is not closed")
                # In Java these nest, intersect or negate.
                out.append(f"\\{letter}" if letter in "[&^" else letter)


def java_pattern(pattern: str) -> str:
    """The Java form of a pattern, to be searched for in a text; ``.`` matches line breaks too."""
    if pattern.startswith("***="):
        return re.escape(pattern[4:])
    reader = _Reader(pattern[4:] if pattern.startswith("***:") else pattern)
    if reader.pattern.startswith("***"):
        raise reader.error("begins with ***")
    out = ["(?s)"]
    while reader.at < len(reader.pattern):
        if reader.take(r"\[\[:<:\]\]"):
            out.append(_WORD_BEGIN)
        elif reader.take(r"\[\[:>:\]\]"):
            out.append(_WORD_END)
        elif reader.take(r"\["):
            out.append(reader.bracket())
        elif back := reader.take(r"\\[1-9][0-9]?"):
            out.append(back)
        elif reader.take(r"\\"):
            out.append(reader.escape(_ESCAPES))
        elif reader.take(r"\$"):
            out.append(r"\z")  # Java's would match before a last line break too
        elif repeat := reader.take(r"(?:[*+?]|\{[0-9]+(?:,[0-9]*)?\})\??"):
            if reader.take(r"[*+?]"):
                raise reader.error("two repetitions in a row")
            out.append(repeat)
        elif group := reader.take(r"\(\?(?::|=|!|<=|<!)"):
            out.append(group)
        elif reader.take(r"\(\?"):
            raise reader.error("options inside a pattern have no equal here")
        else:
            out.append(reader.take("."))
    return "".join(out)

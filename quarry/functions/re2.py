"""Regular expressions of RE2's dialect as Java patterns that match the same texts.

The pattern is parsed and written anew, so that no construct is left to what Java makes of it: `$` is the end of the text and
nothing before it, `.` is all but a line feed, classes hold ASCII, `[[:alpha:]]`, `(?P<name>...)`, `(?U)`, `\\Q...\\E` and `\\z` have
RE2's meaning, and signs that are special in Java only are escaped. What RE2 refuses (look-around, back-references, possessive
and doubled repeats, counts above 1000) and what has no counterpart (`\\C`) is a ValueError. Matching is by backtracking.
"""

from __future__ import annotations

import re
from functools import cache

#: Named classes as ranges of ASCII (fixed values).
POSIX = {
    "alnum": "0-9A-Za-z", "alpha": "A-Za-z", "ascii": r"\x{00}-\x{7F}", "blank": r"\x{09}\x{20}", "cntrl": r"\x{00}-\x{1F}\x{7F}", "digit": "0-9", "graph": r"\x{21}-\x{7E}", "lower": "a-z", "print": r"\x{20}-\x{7E}",
    "punct": r"\x{21}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7E}", "space": r"\x{09}-\x{0D}\x{20}", "upper": "A-Z", "word": "0-9A-Za-z_", "xdigit": "0-9A-Fa-f",
}
PERL = {"d": POSIX["digit"], "s": r"\x{09}\x{0A}\x{0C}\x{0D}\x{20}", "w": POSIX["word"]}
CONTROLS = {"a": 7, "f": 12, "n": 10, "r": 13, "t": 9, "v": 11}
CATEGORIES = "L Lu Ll Lt Lm Lo M Mn Mc Me N Nd Nl No P Pc Pd Ps Pe Pi Pf Po S Sm Sc Sk So Z Zs Zl Zp C Cc Cf Co Cs".split()
SCRIPTS = "Arabic Armenian Bengali Bopomofo Braille Cherokee Common Coptic Cyrillic Devanagari Ethiopic Georgian Gothic Greek Gujarati Gurmukhi Han Hangul Hebrew Hiragana Inherited Kannada Katakana Khmer Lao Latin Malayalam Mongolian Myanmar Ogham Oriya Runic Sinhala Syriac Tamil Telugu Thaana Thai Tibetan Yi".split()
MOST = 1000
_WORD = "(?-i:[0-9A-Za-z_])"
_BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def _char(code: int) -> str:
    c = chr(code)
    return c if c.isascii() and c.isalnum() else rf"\x{{{code:02X}}}"


class _Parser:
    def __init__(self, text: str):
        self.text, self.at = text, 0

    def fail(self, why: str):
        raise ValueError(f"pattern {self.text!r}: {why}")

    def see(self, *starts: str) -> bool:
        return self.text.startswith(starts, self.at)

    def take(self, pattern: str) -> re.Match | None:
        m = re.compile(pattern, re.S).match(self.text, self.at)
        if m:
            self.at = m.end()
        return m

    def whole(self) -> str:
        out = self.group(frozenset())
        if self.at < len(self.text):
            self.fail("unexpected )")
        return out

    def group(self, flags: frozenset[str]) -> str:
        """Alternatives up to a closing bracket or the end. Flags that are set within hold until then."""
        out: list[str] = []
        atom = None  # what a repeat would apply to
        while self.at < len(self.text) and not self.see(")"):
            if self.take(r"\|"):
                out.append("|")
                atom = None
            elif m := self.take(r"[*+?]|\{(\d+)(,(\d*))?\}"):
                if atom is None:
                    self.fail(f"no argument for, or doubled, repetition {m[0]}")
                low, high = int(m[1] or 0), int(m[3] or m[1] or 0)
                if max(low, high) > MOST or (m[3] and high < low):
                    self.fail(f"bad repetition count {m[0]}")
                lazy = bool(self.take(r"\?")) != ("U" in flags)
                out[-1] = f"(?:{atom}){m[0]}" + "?" * lazy
                atom = None
            elif m := self.take(r"\(\?([imsU]*)(?:-([imsU]+))?\)"):
                if m[0] == "(?)":
                    self.fail("empty flags")
                flags, switch = self.switched(flags, m[1], m[2])
                out.append(f"({switch})" if switch else "")
                atom = None
            else:
                atoms = self.literals() if self.see("\\Q") else [self.one(flags)]
                out += atoms
                atom = atoms[-1] if atoms else None
        return "".join(out)

    def switched(self, flags: frozenset[str], on: str, off: str | None) -> tuple[frozenset[str], str]:
        """New flags, and Java's switch for case; the other flags are resolved here."""
        switch = "?iu" if "i" in on and "i" not in (off or "") else "?-iu" if "i" in (off or "") else ""
        return (flags | set(on)) - set(off or ""), switch

    def literals(self) -> list[str]:
        """The characters of `\\Q...\\E`; a repeat behind it is the last one's."""
        return [_char(ord(c)) for c in self.take(r"\\Q(.*?)(?:\\E|$)")[1]]

    def one(self, flags: frozenset[str]) -> str:
        if self.take(r"\("):
            return self.bracketed(flags)
        if self.see("["):
            return self.char_class()
        if self.take(r"\."):
            return r"[\x{00}-\x{10FFFF}]" if "s" in flags else r"[^\n]"
        if self.take(r"\^"):
            return r"(?<![^\n])" if "m" in flags else r"\A"
        if self.take(r"\$"):
            return r"(?![^\n])" if "m" in flags else r"\z"
        if m := self.take(r"\\([AzbB])"):
            return {"A": r"\A", "z": r"\z", "b": _BOUNDARY, "B": f"(?!{_BOUNDARY})"}[m[1]]
        if known := self.known_class():
            positive, negative = known
            return f"[{positive}]" if positive else negative[0]
        return _char(self.character())

    def bracketed(self, flags: frozenset[str]) -> str:
        head = "("
        if self.take(r"\?P<[0-9A-Za-z_]+>"):
            pass  # a name says nothing about what matches
        elif m := self.take(r"\?([imsU]*)(?:-([imsU]+))?:"):
            flags, switch = self.switched(flags, m[1], m[2])
            head = f"({switch or '?'}:"
        elif self.see("?"):
            self.fail(f"({self.text[self.at : self.at + 3]} is not supported")
        inner = self.group(flags)
        if not self.take(r"\)"):
            self.fail("missing )")
        return f"{head}{inner})"

    def known_class(self) -> tuple[str, list[str]] | None:
        """(ranges, []) of a class such as \\d or \\pL, or ("", [a negated class of Java])."""
        if m := self.take(r"\\([dswDSW])"):
            ranges = PERL[m[1].lower()]
            return (ranges, []) if m[1].islower() else ("", [f"[^{ranges}]"])
        if m := self.take(r"\\([pP])(?:\{(\^?)(\w+)\}|(\w))"):
            name, negated = m[3] or m[4], (m[1] == "P") != bool(m[2])
            if name == "Any":
                inside = r"\x{00}-\x{10FFFF}"
            elif name == "C":
                inside = r"\p{Cc}\p{Cf}\p{Co}\p{Cs}"
            elif name in CATEGORIES:
                inside = rf"\p{{{name}}}"
            elif name in SCRIPTS:
                inside = rf"\p{{Is{name}}}"
            else:
                self.fail(f"class {name} is not known")
            return ("", [f"[^{inside}]"]) if negated else (inside, [])
        return None

    def character(self) -> int:
        """One literal character, which may be escaped."""
        if not self.take(r"\\"):
            m = self.take(".")
            if not m:
                self.fail("it ends too early")
            return ord(m[0])
        if m := self.take(r"x\{([0-9A-Fa-f]+)\}|x([0-9A-Fa-f]{2})"):
            code = int(m[1] or m[2], 16)
            if code > 0x10FFFF:
                self.fail("no such character")
            return code
        if m := self.take(r"0[0-7]{0,2}|[1-7][0-7]{1,2}"):
            return int(m[0], 8)
        if m := self.take(r"[afnrtv]"):
            return CONTROLS[m[0]]
        if m := self.take(r"[\x00-\x7f]"):
            if not m[0].isalnum():
                return ord(m[0])
        self.fail(f"escape \\{self.text[self.at - 1 : self.at]} is not supported")

    def char_class(self) -> str:
        negated = bool(self.take(r"\[(\^?)")[1])
        ranges, others, first = [], [], True
        while first or not self.see("]"):
            first = False
            if self.at >= len(self.text):
                self.fail("missing ]")
            if self.see("[:") and (m := self.take(r"\[:(\^?)(\w*):\]")):
                if m[2] not in POSIX:
                    self.fail(f"class {m[0]} is not known")
                if m[1]:
                    others.append(f"[^{POSIX[m[2]]}]")
                else:
                    ranges.append(POSIX[m[2]])
            elif known := self.known_class():
                ranges.append(known[0])
                others += known[1]
            else:
                low = self.character()
                if self.see("-") and not self.see("-]") and self.take("-"):
                    high = self.character()
                    if high < low:
                        self.fail("bad range in a class")
                    ranges.append(f"{_char(low)}-{_char(high)}")
                else:
                    ranges.append(_char(low))
        self.take(r"\]")
        inside = "".join(ranges)
        one = "|".join([*([f"[{inside}]"] if inside else []), *others])
        if negated:
            return rf"(?:(?!{one})[\x{{00}}-\x{{10FFFF}}])"
        return one if len(others) + bool(inside) == 1 else f"(?:{one})"


@cache
def translate(pattern: str) -> str:
    """The Java pattern for a pattern of RE2."""
    return _Parser(pattern).whole()

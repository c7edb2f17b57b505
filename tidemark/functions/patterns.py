"""Regular expressions with one meaning in the JVM: Unicode classes, only ``\\n`` ends a line."""

from __future__ import annotations


def unicode_pattern(pattern: str, ignore_case: bool = False, many_lines: bool = False, dot_all: bool = False) -> str:
    """``pattern`` with the flags under which ``\\w``, ``\\b``, ``\\s`` and case folding cover all letters
    and ``.``, ``^`` and ``$`` know no other line end than ``\\n``."""
    flags = "Ud" + ("iu" if ignore_case else "") + ("m" if many_lines else "") + ("s" if dot_all else "")
    return f"(?{flags}){pattern}"

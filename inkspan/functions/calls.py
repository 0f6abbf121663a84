"""Arguments of JavaScript calls; without Spark, so that workers get it alone."""

from __future__ import annotations

import html
import re

_QUOTED = r"'[^'\\]*'"
#: Arguments that are all in plain single quotes.
_PLAIN = re.compile(rf"\s*{_QUOTED}(?:,\s*{_QUOTED})*\)")
_EACH = re.compile(r"'([^'\\]*)'")


def arguments(text: str | None, name: str) -> list[str]:
    """The string arguments of the first call of a JavaScript function in a handler; a state machine over quotes, escapes and brackets."""
    at = (text or "").find(name + "(")
    if at < 0:
        return []
    source = html.unescape(text[at + len(name) + 1 :])
    if plain := _PLAIN.match(source):
        return ["" if x in ("null", "None", "undefined") else x for x in _EACH.findall(plain[0])]
    out, held, quote, depth, filled, i = [], [], "", 0, False, 0
    while i < len(source):
        ch = source[i]
        if quote:
            if ch == "\\" and i + 1 < len(source):
                i += 1
                held.append({"n": "\n", "t": "\t", "r": "\r"}.get(source[i], source[i]))
            elif ch == quote:
                quote = ""
            else:
                held.append(ch)
        elif ch in "'\"":
            quote, filled, held = ch, True, []
        elif ch == ")" and not depth:
            break
        elif ch == "," and not depth:
            out.append("".join(held) if filled else "".join(held).strip())
            held, filled = [], False
        else:
            depth += (ch == "(") - (ch == ")")
            if not filled:
                held.append(ch)
        i += 1
    if held or filled or out:
        out.append("".join(held) if filled else "".join(held).strip())
    return ["" if x in ("null", "None", "undefined") else x for x in out]

"""Shell lines as commands with their flags. Quoting has no built-in expression, so lines go in Arrow batches."""

from __future__ import annotations

import posixpath
import re
import shlex

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Operators that part segments, programs that run another, what a command and a flag look like (fixed values).
OPERATORS = {";", "|", "||", "&&", "&", "\n"}
MULTICALL = {"busybox"}
NAME = re.compile(r"^[a-z][a-z0-9_.-]{0,63}$")
FLAG = re.compile(r"^-{1,2}[A-Za-z][\w\-]*$")


def command_name(token: str) -> str:
    """The program that a word calls, without its folder and leading dots; empty if it can't be one."""
    found = NAME.fullmatch(posixpath.basename(token).lstrip(".").lower())
    return found[0] if found else ""


def words_of(line: str) -> list[str]:
    """Words with quotes resolved; parted by white space alone where quotes don't close."""
    try:
        return shlex.split(line)
    except ValueError:
        return line.split()


#: What the next word of a segment may be: its program, the program that a multicall one runs, an argument, or of no use.
_PROGRAM, _APPLET, _ARGUMENT, _SKIPPED = range(4)


def parse(line: str | None) -> list[tuple[str, list[str]]]:
    """(command, flags) of each segment, each command with the same flags once.

    One pass over the words; `running` has the programs of the segment that are known so far, which all
    get its further flags. An operator ends the segment.
    """
    distinct: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    running: list[tuple[str, list[str]]] = []
    awaited = _PROGRAM
    for word in [*words_of(line or ""), ";"]:
        if word in OPERATORS:
            for name, flags in running:
                distinct.setdefault((name, tuple(sorted(flags))), flags)
            running, awaited = [], _PROGRAM
        elif awaited == _PROGRAM:
            if "=" in word and not word.startswith("-"):
                continue  # an assignment before the program
            if name := command_name(word):
                running.append((name, []))
            awaited = _SKIPPED if not name else _APPLET if name in MULTICALL else _ARGUMENT
        elif awaited != _SKIPPED and FLAG.match(word):
            for _, flags in running:
                flags.append(word)
        elif awaited == _APPLET and "=" not in word:
            if name := command_name(word):
                running.append((name, []))
            awaited = _ARGUMENT
    return [(name, flags) for (name, _), flags in distinct.items()]


def commands(line: Column) -> Column:
    """array<struct(command, flags)>."""

    def parsed(lines: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("command", pa.string()), ("flags", pa.list_(pa.string()))]))
        return pa.array([[{"command": c, "flags": f} for c, f in parse(x)] for x in lines.to_pylist()], kind)

    return F.arrow_udf(parsed, "array<struct<command:string,flags:array<string>>>")(line)

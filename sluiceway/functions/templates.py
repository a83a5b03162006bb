"""Many line templates at once: each line goes to the first template that it fits."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import capture_pattern

#: Literal parts below this length say too little about a line.
SHORTEST = 3
_PLAIN = re.compile(r"[A-Za-z0-9 _:=/,@#%&;<>'\"!~`-]")


def literals(template: str) -> list[str]:
    """Texts that every line of a template contains: its parts outside fields, groups, classes and repeated characters."""
    if "|" in re.sub(r"\\.|\(\?:[^()]*\)", "", template):
        return []
    found, run, depth, at = [], "", 0, 0

    def end() -> None:
        nonlocal run
        if len(run) >= SHORTEST:
            found.append(run)
        run = ""

    while at < len(template):
        ch = template[at]
        field = re.compile(r"%\{\w+(?::\w+)?\}").match(template, at)
        if field:
            end()
            at = field.end()
        elif ch in "([":
            end()
            depth += 1
            at += 1
        elif ch in ")]":
            depth -= 1
            at += 1
        elif ch in "*?{":  # the character before may be missing
            run = run[:-1]
            end()
            at = template.index("}", at) + 1 if ch == "{" else at + 1
        elif depth == 0 and ch == "\\" and at + 1 < len(template) and not template[at + 1].isalnum():
            run += template[at + 1]
            at += 2
        elif depth == 0 and _PLAIN.fullmatch(ch):
            run += ch
            at += 1
        else:
            end()
            at += 2 if ch == "\\" else 1
    end()
    return found


def route_lines(df: DataFrame, column: str, templates: Mapping[str, str]) -> DataFrame:
    """Add ``template``, the name of the first template that a line fits, and ``fields``, its captures by name.

    Templates are written as for ``capture_fields``. All are tried in one pass: the literal parts of the templates are looked for
    in a line first, each distinct part once, and only templates whose parts are all there meet their regular expression. A line
    that fits none has null in both columns.
    """
    line = F.col(column)
    parts: dict[str, Column] = {}
    choice = None
    for name, template in templates.items():
        pattern, names = capture_pattern(template)
        fits = line.rlike(pattern)
        for part in sorted(literals(template), key=len):
            fits = parts.setdefault(part, F.contains(line, F.lit(part))) & fits
        captures = [x for i, n in enumerate(names) for x in (F.lit(n), F.regexp_extract(line, pattern, i + 1))]
        fields = F.create_map(*captures) if captures else F.create_map().cast("map<string,string>")
        value = F.struct(F.lit(name).alias("template"), fields.alias("fields"))
        choice = F.when(fits, value) if choice is None else choice.when(fits, value)
    routed = df.withColumn("_routed", choice)
    return routed.withColumns({"template": F.col("_routed.template"), "fields": F.col("_routed.fields")}).drop("_routed")

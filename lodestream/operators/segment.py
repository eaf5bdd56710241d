"""Cutting a text into blocks, tables out of texts, and vertical tables into rows (SG1, SG2, SG4-SG11, N9, N12).

The strategies need the order of lines, so they run in Python, a whole Arrow batch at a
time; everything before and after them stays in expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_ROW = re.compile(r"^\s*\|(.+)\|\s*$|^([^|]+(?:\|[^|]+){2,})$")
_NUMBERED = re.compile(r"^\s*(?:\(?\d{1,2}[.)]|(?:role|position|requirement)\s*#?\s*\d{1,2}\b[:.)-]?)\s*\S", re.I)
_BULLET = re.compile(r"^\s*[-*•]\s+\S")
_MARKDOWN = re.compile(r"^\s*#{1,4}\s+\S|^\s*\*\*[^*]+\*\*\s*:?\s*$")
_RULE = re.compile(r"^[\s|:+=-]+$")
_LABEL = re.compile(r"^\s*([A-Za-z][A-Za-z .]{1,28}?)\s*(?::|=| - )\s*\S")
#: Words of a bullet that make it a record of its own and no mere duty.
_RECORD = re.compile(r"\b(?:\d+\s*(?:-|–|to)?\s*\d*\+?\s*(?:yrs?|years?)|positions?|openings?|location|lpa|\d+\s+days)\b", re.I)

#: Synonyms of table headers (fixed values).
HEADERS = {
    "job_title": ("role", "position", "job title", "title", "skill"), "location": ("city", "location", "work location"), "experience": ("exp", "experience", "total experience", "years"),
    "number_of_positions": ("count", "openings", "no. of positions", "positions"), "yearly_budget": ("budget", "rate", "ctc"), "notice_period": ("notice", "joining"), "work_mode": ("mode", "work mode"),
}
_FIELD_OF = {name: field for field, names in HEADERS.items() for name in names}


def header_field(cell: str) -> str | None:
    """The field that a header cell names: its synonym, or one that the cell begins or ends with."""
    c = re.sub(r"\s+", " ", cell).strip(" :*").lower()
    if c in _FIELD_OF:
        return _FIELD_OF[c]
    hits = [n for n in _FIELD_OF if len(n) > 3 and (c.startswith(n + " ") or c.endswith(" " + n))]
    return _FIELD_OF[max(hits, key=len)] if hits else None


def table_blocks(lines: list[str]) -> list[tuple[str, dict[str, str]]]:
    """Rows of the tables in lines, as (text, fields), where a header row names two fields or more.
    A table of two columns whose first cells are headers is one row."""
    out: list[tuple[str, dict[str, str]]] = []
    run: list[list[str]] = []

    def close() -> None:
        if len(run) >= 2:
            names = [header_field(c) for c in run[0]]
            first = [header_field(r[0]) for r in run]
            if sum(n is not None for n in names) >= 2:
                for r in run[1:]:
                    fields = {n: v for n, v in zip(names, r) if n and v}
                    if fields:
                        out.append((" | ".join(r), fields))
            elif all(len(r) == 2 for r in run) and sum(f is not None for f in first) >= 2:
                out.append(("\n".join(" | ".join(r) for r in run), {f: r[1] for f, r in zip(first, run) if f and r[1]}))
        run.clear()

    for line in [*lines, ""]:
        m = _ROW.match(line)
        if m and not _RULE.match(line):
            run.append([c.strip() for c in (m[1] or m[2]).split("|")])
        elif not (m or _RULE.match(line) and line.strip()):
            close()
    return out


def segment(text: str | None) -> list[tuple[str, str, dict[str, str]]]:
    """(strategy, block, fields) of the records in a text. The first strategy that finds any
    stands: table rows, numbered items, repeated labels, bullets that are records, headings;
    else the text is one block. Text before the first block is context of all blocks."""
    if not text or not text.strip():
        return []
    lines = text.replace("\r", "").split("\n")
    rows = table_blocks(lines)
    if rows:
        return [("table", block, fields) for block, fields in rows]

    def starts(at: list[int], strategy: str) -> list[tuple[str, str, dict[str, str]]]:
        context = [x for x in lines[: at[0]] if x.strip()]
        return [(strategy, "\n".join([*context, *lines[a:b]]).strip(), {}) for a, b in zip(at, [*at[1:], len(lines)])]

    numbered = [i for i, x in enumerate(lines) if _NUMBERED.match(x)]
    if len(numbered) >= 2:
        return starts(numbered, "numbered")
    labels = [(i, m[1].strip().lower()) for i, x in enumerate(lines) if (m := _LABEL.match(x))]
    titles = [i for i, name in labels if header_field(name) == "job_title"]
    if len(titles) >= 2:
        return starts(titles, "labels")
    bullets = [i for i, x in enumerate(lines) if _BULLET.match(x) and _RECORD.search(x)]
    if len(bullets) >= 2:
        return starts(bullets, "bullets")
    heads = [i for i, x in enumerate(lines) if _MARKDOWN.match(x)]
    if len(heads) >= 2:
        return starts(heads, "headings")
    return [("single", text.strip(), {})]


def without_tables(text: str | None, columns: tuple[str, ...], most: int = 50) -> str | None:
    """The text without tables of given columns: from a line that holds two of them and no
    sentence, up to a blank line that a paragraph follows, a closing, or ``most`` lines.
    Lines that hold an id (letters, a dash, five digits) always stay."""
    if text is None:
        return None
    keep: list[str] = []
    inside = 0
    lines = text.split("\n")
    for k, line in enumerate(lines):
        low = line.lower()
        if not inside and sum(c in low for c in columns) >= 2 and not line.rstrip().endswith((".", "?", "!")):
            inside = 1
        elif inside:
            inside += 1
            sentence = k + 1 < len(lines) and lines[k + 1].rstrip().endswith((".", "?", "!", ":", ","))
            if inside > most or not line.strip() and sentence:
                inside = 0
        if not inside or re.search(r"\b[A-Za-z]{2,}-\d{5,}", line):
            keep.append(line)
    return "\n".join(keep)


def vertical_rows(text: str | None) -> list[dict[str, str]]:
    """Rows of a table that lost its layout: a run of two or more header lines, then as many
    lines a row, up to a blank line or a rest that fills no row."""
    if not text:
        return []
    lines = [x.strip() for x in text.replace("\r", "").split("\n")]
    i = 0
    while i < len(lines):
        j = i
        while j < len(lines) and lines[j] and header_field(lines[j]):
            j += 1
        if j - i >= 2:
            names = [header_field(x) for x in lines[i:j]]
            out = []
            while j + len(names) <= len(lines) and all(lines[j : j + len(names)]):
                out.append(dict(zip(names, lines[j : j + len(names)])))
                j += len(names)
            if out:
                return out
        i = max(i + 1, j)
    return []


_SCHEMA = "block_no long, strategy string, block string, fields map<string,string>"


def segmented(df: DataFrame, text: str) -> DataFrame:
    """One row per block of ``text`` with the other columns; null and blank texts have none."""
    kept = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for k, t in enumerate(b.column(len(kept)).to_pylist()):
                for no, block in enumerate(segment(t), 1):
                    at.append(k)
                    rows.append((no, *block))
            no, strategy, block, fields = zip(*rows) if rows else ((), (), (), ())
            take = pa.array(at, pa.int64())
            made = [pa.array(no, pa.int64()), pa.array(strategy, pa.string()), pa.array(block, pa.string()), pa.array([list(f.items()) for f in fields], pa.map_(pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(take) for i in range(len(kept))), *made], [*kept, "block_no", "strategy", "block", "fields"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema)
    return df.select(*kept, text).mapInArrow(run, f"{names}, {_SCHEMA}")

"""Text PDFs of layout records: each record's page begins a new sheet, long lines are wrapped, full sheets continued.

A plain writer for the standard Helvetica font, without any library. Files are written by the executors, one a record.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: Sheet sizes in points.
SIZES = {"A4": (595, 842), "LETTER": (612, 792)}
#: Mean width of a character against the font size, and narrow and wide ones.
NARROW, WIDE = set("iljtfrI.,:;'!|()[] "), set("mwMW@%")


def width(text: str, size: float) -> float:
    return size * sum(0.29 if c in NARROW else 0.86 if c in WIDE else 0.67 if c.isupper() else 0.54 for c in text)


def wrap(text: str, size: float, room: float) -> list[str]:
    """Lines that fit into the room; a word too long for it is divided."""
    out = []
    for line in text.split("\n"):
        cur = ""
        for w in line.split():
            if cur and width(f"{cur} {w}", size) <= room:
                cur += " " + w
                continue
            if cur:
                out.append(cur)
            while width(w, size) > room and len(w) > 1:
                k = max(1, int(len(w) * room / width(w, size)))
                out.append(w[:k])
                w = w[k:]
            cur = w
        out.append(cur)
    return out


def render(pages: list[list[str]], title: str = "", size: float = 10, margin: float = 50, sheet: str = "A4") -> bytes:
    """A PDF with the texts of each page, from the top; characters outside the font's set become question marks."""
    w, h = SIZES[sheet]
    lead, sheets = size * 1.4, []
    for n, texts in enumerate(pages):
        lines = ([title, ""] if title and n == 0 else []) + [x for t in texts for x in [*wrap(t, size, w - 2 * margin), ""]]
        per = max(1, int((h - 2 * margin) / lead))
        sheets += [lines[k : k + per] for k in range(0, len(lines), per)] or [[]]
    objects: list[bytes] = [b"<< /Type /Catalog /Pages 2 0 R >>", b"", b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>"]
    kids = []
    for lines in sheets or [[]]:
        body = b"".join(b"(" + x.encode("cp1252", "replace").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") + b") Tj T*\n" for x in lines)
        stream = b"BT /F1 %g Tf %g TL %g %g Td\n" % (size, lead, margin, h - margin - size) + body + b"ET"
        kids.append(len(objects) + 1)
        objects.append(b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 %d %d] /Resources << /Font << /F1 3 0 R >> >> /Contents %d 0 R >>" % (w, h, len(objects) + 2))
        objects.append(b"<< /Length %d >>\nstream\n" % len(stream) + stream + b"\nendstream")
    objects[1] = b"<< /Type /Pages /Count %d /Kids [%s] >>" % (len(kids), b" ".join(b"%d 0 R" % k for k in kids))
    out, at = b"%PDF-1.4\n", []
    for k, o in enumerate(objects, 1):
        at.append(len(out))
        out += b"%d 0 obj\n" % k + o + b"\nendobj\n"
    table = b"".join(b"%010d 00000 n \n" % a for a in at)
    return out + b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + table + b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, len(out))


def write_pdfs(pages: DataFrame, path: str, key: str = "layout_id", size: float = 10, margin: float = 50, sheet: str = "A4") -> None:
    """pages (key, page, texts) to <key>.pdf each, in a folder that all executors share. A record's text must fit a row."""
    docs = pages.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("page", "texts"))).alias("p"))

    def run(rows: Iterator[Row]) -> None:
        os.makedirs(path, exist_ok=True)
        for r in rows:
            with open(os.path.join(path, f"{r[key]}.pdf"), "wb") as f:
                f.write(render([list(x["texts"] or []) for x in r["p"]], str(r[key]), size, margin, sheet))

    docs.foreachPartition(run)

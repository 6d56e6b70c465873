"""python -m folium.cli COMMAND ...: the steps from files to files."""

from __future__ import annotations

import argparse
import json

from folium.functions import lexicon as lx
from folium.session import build_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="folium", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *args: tuple) -> None:
        c = sub.add_parser(name, help=text)
        for flags, kw in args:
            c.add_argument(*flags, **kw)

    inp, out = (("--in",), {"dest": "path", "required": True}), (("--out",), {"required": True})
    command("clean", "clean the strings of JSON documents", inp, out, (("--report",), {"required": True}), (("--ext",), {"default": ".json"}), (("--overwrite",), {"action": "store_true"}), (("--dry-run",), {"action": "store_true"}), (("--keys-only",), {"action": "count", "default": 0}), (("--keys",), {"nargs": "*"}), (("--rules",), {}))
    command("blocks", "layout JSON to the block table", inp, out, (("--min-chars",), {"type": int, "default": 25}))
    command("search", "block table to search documents", inp, out)
    command("markdown", "block table to a Markdown file a document", inp, out)
    command("chunks", "block table to a Markdown file a block", inp, out, (("--prefix",), {"default": ""}))
    command("pages-text", "layout JSON to the text of each page", inp, out)
    command("pdf", "layout JSON to text PDFs", inp, out, (("--fontsize",), {"type": float, "default": 10}), (("--margin",), {"type": float, "default": 50}), (("--pagesize",), {"default": "A4"}))
    command("fetch", "bulletins that index pages link to", (("--url",), {"nargs": "+", "required": True}), out, (("--languages",), {"nargs": "+", "default": ["es", "eu"]}), (("--max-docs",), {"type": int}), (("--rate-limit",), {"type": float, "default": 1.5}))
    command("graph", "JSON documents to node and edge tables", inp, out, (("--max-depth",), {"type": int, "default": 50}))
    command("consolidate", "node tables to one", inp, out)
    command("schema", "types and relations of JSON documents", inp, out)
    command("resolve", "relations to edges", (("--nodes",), {"required": True}), (("--relations",), {"required": True}), out, (("--orphans-out",), {}), (("--default-type",), {"default": lx.EDGE_TYPE}), (("--merge",), {}), (("--allow-orphans",), {"action": "store_true"}), (("--capture",), {"action": "store_true"}), (("--preview-nodes",), {"action": "store_true"}))
    command("validate", "rows of a CSV file, its header among them", inp)
    text, file = (("--text",), {}), (("--file",), {"dest": "path"})
    field, maybe = (("--field",), {"default": "paragraphs"}), (("--out",), {})
    command("language", "language of a text or of documents", text, file, field, maybe)
    command("domain", "domain of a text or of documents", text, file, field, maybe, (("--threshold",), {"type": float, "default": lx.DOMAIN_THRESHOLD}))
    command("pages", "saved bulletin pages to documents", inp, out)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = build_session("folium")
    from folium.operators import domain, language
    from folium.plans import pipelines as run
    from folium.sources import readers

    c = a.command
    if c == "clean":
        keys = None if not a.keys_only else tuple(a.keys) if a.keys_only > 1 and a.keys else lx.TEXT_KEYS
        for r in run.clean(spark, a.path, a.out, a.report, ext=a.ext, overwrite=a.overwrite, dry_run=a.dry_run, keys=keys, rules=readers.load_rules(a.rules)).limit(50).collect():
            print(*r, sep=",")
    elif c == "blocks":
        run.blocks(spark, a.path, a.out, a.min_chars)
    elif c in ("search", "markdown", "consolidate"):
        getattr(run, c)(spark, a.path, a.out)
    elif c == "chunks":
        run.chunks(spark, a.path, a.out, a.prefix)
    elif c == "pages-text":
        run.pages_text(spark, a.path, a.out)
    elif c == "pdf":
        run.text_pdfs(spark, a.path, a.out, size=a.fontsize, margin=a.margin, sheet=a.pagesize)
    elif c == "fetch":
        run.year(spark, a.url, a.languages, a.out, a.max_docs, a.rate_limit)
    elif c == "graph":
        return 0 if run.tree_graph(spark, a.path, a.out, a.max_depth) else 1
    elif c == "schema":
        run.schemas(spark, a.path, a.out)
    elif c == "resolve":
        if a.preview_nodes:
            for r in readers.read_nodes(spark, a.nodes).select("id", "name", "type", "source").orderBy("id").limit(20).collect():
                print(*r, sep=",")
            return 0
        print(run.resolve_relations(spark, a.nodes, a.relations, a.out, a.orphans_out, default_type=a.default_type, merge=a.merge, allow_orphans=a.allow_orphans, capture=a.capture))
    elif c == "validate":
        print(readers.count_csv_rows(spark, a.path))
    elif c == "pages":
        run.bulletin_documents(spark, a.path, a.out)
    elif a.text is not None:
        d = spark.createDataFrame([(a.text,)], "text string")
        got = language.score_language(d, "text") if c == "language" else domain.score_domain(d, "text", a.threshold)
        print(json.dumps(got.drop("text").first().asDict(), ensure_ascii=False))
    elif a.path and a.out:
        run.annotate_language(spark, a.path, a.out, a.field) if c == "language" else run.annotate_domain(spark, a.path, a.out, a.field, a.threshold)
    else:
        raise SystemExit("either --text, or --file and --out")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

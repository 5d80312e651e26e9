"""The command line: sources, fetch, normalise, enrich, index, search, stats, serve, over a root folder.

`python -m casebook.cli [--root DIR] COMMAND ...`. The root is $CASEBOOK_DATA, or ./data. Every tool of the service can be
asked by `serve`, which reads a JSON request a line ({"tool": ..., "arguments": {...}}) and writes a JSON answer a line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from casebook import api
from casebook.operators import segments
from casebook.plans import stages
from casebook.sources import registry, store


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="casebook", description=__doc__.splitlines()[0])
    p.add_argument("--root", default=os.environ.get("CASEBOOK_DATA", "data"))
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("sources", help="list the sources and their policies")
    f = sub.add_parser("fetch", help="fetch snapshots; the only command that uses the network")
    f.add_argument("source", choices=sorted(registry.REGISTRY))
    f.add_argument("--start")
    f.add_argument("--end")
    f.add_argument("--limit", type=int)
    f.add_argument("--min-interval", type=float, help="slower than the policy; never faster")
    for flag, text in (("vernacular", "debates: speeches in other languages"), ("versions", "statutes: all versions"), ("include-sl", "statutes: subsidiary legislation"), ("include-repealed", "statutes: repealed acts")):
        f.add_argument(f"--{flag}", action="store_true", help=text)
    for name in ("normalise", "enrich"):
        sub.add_parser(name).add_argument("source", choices=sorted(registry.REGISTRY))
    i = sub.add_parser("index")
    i.add_argument("--source", action="append", choices=sorted(registry.REGISTRY))
    i.add_argument("--update", action="store_true", help="add what is new or changed; keep the rest")
    s = sub.add_parser("search")
    s.add_argument("query")
    s.add_argument("--corpus", action="append")
    s.add_argument("--limit", type=int, default=10)
    sub.add_parser("stats")
    sub.add_parser("serve")
    return p


def opened(spark: SparkSession, root: str):
    """Tables and search index of a root."""
    place = f"{root}/index"
    return store.connect(spark, place), segments.opened(spark, f"{place}/search")


def show(out, rows: list[dict], columns: list[str]) -> None:
    """A table of rows."""
    cells = [columns, *([" ".join(str("" if r.get(c) is None else r[c]).split()) for c in columns] for r in rows)]
    wide = [min(60, max(len(line[i]) for line in cells)) for i in range(len(columns))]
    for line in cells:
        print("  ".join(x.ljust(w) for x, w in zip(line, wide, strict=True)).rstrip(), file=out)


def main(argv: list[str] | None = None, spark: SparkSession | None = None, out=sys.stdout, lines=sys.stdin) -> int:
    a = arguments().parse_args(argv)
    spark = spark or SparkSession.builder.appName("casebook").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "sources":
        show(out, api.records(registry.sources(spark)), ["name", "corpus", "authority", "status", "min_interval", "adapter_version"])
    elif a.command == "fetch":
        options = {"vernacular": a.vernacular, "versions": a.versions, "include_sl": a.include_sl, "include_repealed": a.include_repealed}
        print(json.dumps(stages.fetch(spark, a.root, a.source, a.start, a.end, a.limit, a.min_interval, **options)), file=out)
    elif a.command == "normalise":
        print(json.dumps(stages.normalise(spark, a.root, a.source)), file=out)
    elif a.command == "enrich":
        refs = stages.enrich(store.read_documents(spark, f"{a.root}/documents/{a.source}"))
        stages.write_refs(refs, f"{a.root}/refs/{a.source}")
        print(json.dumps({"refs": store.read_refs(spark, f"{a.root}/refs/{a.source}").count()}), file=out)
    elif a.command == "index":
        print(json.dumps(stages.index(spark, a.root, a.source, a.update)), file=out)
    else:
        try:
            tables, index = opened(spark, a.root)
        except FileNotFoundError:
            print("No index. Run `index` first.", file=out)
            return 1
        if a.command == "search":
            got = api.handle(tables, index, "search", {"query": a.query, "corpus": a.corpus, "limit": a.limit})
            if not got.get("hits"):
                print(got.get("message") or f"No hits for {a.query!r}. `stats` shows what is covered.", file=out)
                return 1 if "error" in got else 0
            show(out, got["hits"], ["urn", "citation", "issued", "snippet"])
        elif a.command == "stats":
            rows = api.handle(tables, index, "corpus_stats", {})["corpora"]
            show(out, [r | {"quality": "  ".join(f"{k}={v}" for k, v in r["quality"].items()) or "-"} for r in rows], ["corpus", "document_count", "earliest", "latest", "adapter_version", "parser_rev", "quality"])
        else:
            for line in filter(str.strip, lines):
                try:
                    asked = json.loads(line)
                    answer = {"tools": api.TOOLS} if asked.get("tool") == "list_tools" else api.handle(tables, index, asked.get("tool"), asked.get("arguments") or {})
                except (ValueError, TypeError, AttributeError) as e:
                    answer = {"error": "invalid_argument", "message": str(e)}
                print(json.dumps(answer, default=str, ensure_ascii=False), file=out, flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())

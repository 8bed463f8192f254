"""Command line: harvest, normalize, aggregate, enrich, serve, show tables, ask read-only SQL."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from turnstone.session import build_session
from turnstone.sources import schemas, tables


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="turnstone", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    normalize = commands.add_parser("normalize", help="parse raw days into tables")
    normalize.add_argument("raw")
    normalize.add_argument("tables")
    aggregate = commands.add_parser("aggregate", help="write cubes from the tables of a folder")
    aggregate.add_argument("tables")
    aggregate.add_argument("out")
    aggregate.add_argument("--only", nargs="*")
    aggregate.add_argument("--raw", help="folder of raw days, for the coverage cube")
    database = commands.add_parser("db", help="a catalog database of the cubes")
    database.add_argument("out")
    database.add_argument("name")
    database.add_argument("--tables", help="also the transcript tables of this folder")
    sources = commands.add_parser("sources", help="the sources of raw days")
    sources.set_defaults(table=None)
    fetch = commands.add_parser("harvest", help="fetch days that are missing, newest first")
    fetch.add_argument("jurisdiction")
    fetch.add_argument("raw")
    fetch.add_argument("--start", required=True)
    fetch.add_argument("--end", required=True)
    fetch.add_argument("--refresh-window", type=int, default=0)
    for name, text in (("embed", "embed what is new or changed"), ("themes", "label subjects of days without labels"), ("prune", "delete vectors and labels of days that are gone"), ("api", "the search service over HTTP"), ("tools", "the tool protocol on standard input and output")):
        enrich = commands.add_parser(name, help=text)
        enrich.add_argument("tables")
        enrich.add_argument("--provider")
        if name == "themes":
            enrich.add_argument("taxonomy", help="a YAML file")
            enrich.add_argument("--engine", choices=("embedding", "llm"), default="embedding")
        if name == "api":
            enrich.add_argument("--port", type=int, default=8000)
    status = commands.add_parser("status", help="partitions and rows of each table")
    status.add_argument("tables")
    sql = commands.add_parser("sql", help="one read-only statement over the tables")
    sql.add_argument("tables")
    sql.add_argument("statement")
    commands.add_parser("schema", help="columns of every table")
    return parser


def main(arguments: list[str] | None = None) -> int:
    args = build_parser().parse_args(arguments)
    if args.command == "schema":
        print(json.dumps({name: [[f.name, f.dataType.simpleString()] for f in s.fields] for name, s in schemas.TABLES.items()}))
        return 0
    if args.command == "sources":
        from turnstone.sources import harvest, store  # noqa: F401  the adapters register themselves

        print(json.dumps(store.all_adapters()))
        return 0
    if args.command == "harvest":
        return _harvest(args)
    spark = build_session()
    if args.command in ("embed", "themes", "prune", "api", "tools"):
        return _enrich(spark, args)
    if args.command == "normalize":
        from turnstone.sources.transcripts import normalize, raw_files, write_tables

        write_tables(normalize(raw_files(spark, args.raw)), args.tables)
    elif args.command == "aggregate":
        from turnstone.plans import gold

        side = {"raw_days": tables.raw_days(spark, args.raw)} if args.raw else {}
        print(json.dumps(gold.write_cubes(spark, gold.frames_of(spark, args.tables, **side), args.out, args.only)))
    elif args.command == "db":
        from turnstone.plans import gold

        silver = gold.frames_of(spark, args.tables) if args.tables else None
        print(json.dumps(gold.database(spark, args.out, args.name, silver)))
    elif args.command == "status":
        tables.register(spark, args.tables, schemas.TABLES)
        for name in schemas.TABLES:
            row = spark.table(name).selectExpr("count(*) as n", "count(distinct jurisdiction, date, house) as days").first()
            print(json.dumps({"table": name, "rows": row.n, "days": row.days}))
    elif args.command == "sql":
        from turnstone.sources.sqltool import read_only

        tables.register(spark, args.tables, schemas.TABLES)
        paths = {p.stem: str(p) for p in Path(args.tables).glob("*.parquet")}
        for row in read_only(spark, args.statement, paths).toJSON().collect():
            print(row)
    return 0


def _harvest(args: argparse.Namespace) -> int:
    import datetime as dt

    from turnstone.sources import harvest, store  # noqa: F401

    try:
        done = store.harvest(store.RawStore(args.raw), store.get_adapter(args.jurisdiction), dt.date.fromisoformat(args.start), dt.date.fromisoformat(args.end), args.refresh_window)
    except NotImplementedError as error:
        print(error)
        return 2
    print(json.dumps({"days": done}))
    return 0


def _enrich(spark, args: argparse.Namespace) -> int:
    from turnstone.operators import pipeline, providers
    from turnstone.plans import gold

    frames = gold.frames_of(spark, args.tables)
    if args.command == "prune":
        print(json.dumps({name: pipeline.prune_partitions(spark, f"{args.tables}/{name}", f"{args.tables}/texts") for name in ("embeddings", "subject_themes")}))
        return 0
    provider = providers.resolve(args.provider)
    if args.command == "embed":
        print(json.dumps({"days": pipeline.embed_pending(frames, providers.embedder(provider), args.tables, provider.embed_model, provider.name)}))
    elif args.command == "themes":
        from turnstone.sources.vocabulary import taxonomy

        by = {"embedder": providers.embedder(provider)} if args.engine == "embedding" else {"completer": lambda: providers.completer(provider)}
        model = provider.embed_model if args.engine == "embedding" else provider.chat_model
        print(json.dumps({"days": pipeline.classify_pending(frames, taxonomy(spark, Path(args.taxonomy).read_text()), args.tables, model, provider=provider.name, **by)}))
    else:
        from turnstone import serve
        from turnstone.sources.vector_index import TableIndex

        embedded = frames["embeddings"].where(frames["embeddings"]["model"] == provider.embed_model)
        service = serve.SearchService(TableIndex(spark, pipeline.citations(frames, embedded)), providers.embedder(provider), provider.embed_model)
        if args.command == "tools":
            serve.serve_tools(serve.Tools(spark, frames, service.search), sys.stdin, sys.stdout)
        else:
            from wsgiref.simple_server import make_server

            make_server("127.0.0.1", args.port, serve.app(service)).serve_forever()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

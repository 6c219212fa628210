"""Command line: ingest, search, eval-gen, eval, status, collections, serve."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict, replace

from pyspark.sql import SparkSession

from siltstone import sources
from siltstone.config import Config
from siltstone.operators import client, models, rerank, state
from siltstone.operators.extract import http_extractor
from siltstone.operators.store import Collection, collections, reconstruct
from siltstone.plans import evalrun
from siltstone.plans.ingest import Models, ingest, load_stats
from siltstone.plans.search import Searcher, SearchModels


def session() -> SparkSession:
    return SparkSession.builder.appName("siltstone").config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate()


def _embedder(config: Config) -> models.Embedder:
    if config.model.url:
        return models.ServiceEmbedder(client.TextModel(config.model.url, config.model.embed_model))
    return models.HashEmbedder(int(config.model.embed_model.rpartition("-")[2]))


def text_model(config: Config, name: str | None = None) -> client.TextModel | None:
    """The service's model ``name``, or its gate model; None without a service."""
    return client.TextModel(config.model.url, name or config.model.gate_model) if config.model.url else None


def ingest_models(config: Config, contextual: bool = False) -> Models:
    """What ``config`` names: with a service its models, else the offline ones; a gate needs a service."""
    model, gate = text_model(config), None
    if config.gate_enabled:
        if model is None:
            raise ValueError("the gate is enabled, but no model service is set (model.url)")
        gate = client.verdicts(model, config.gate_criteria)
    context = None
    if contextual or config.contextual.enabled:
        context = client.contexts(text_model(config, config.contextual.model)) if model else models.first_sentence
    return Models(_embedder(config), gate=gate, context=context, binary=http_extractor(config.extract.url) if config.extract.url else None)


def search_models(config: Config) -> SearchModels:
    scorer = rerank.http_scorer(config.rerank.url) if config.rerank.url else rerank.overlap_score
    if not config.model.url:
        return SearchModels(_embedder(config), rerank=scorer)
    return SearchModels(
        _embedder(config), expand=client.paraphrases(text_model(config, config.multi_query.model)),
        grade_all=client.grades(text_model(config, config.corrective.model)), rerank=scorer,
    )


def searcher(spark: SparkSession, config: Config) -> Searcher:
    collection = Collection(spark, config.store.path, config.collection)
    points = collection.points()
    if points is None:
        raise SystemExit(f"collection {config.collection!r} is empty")
    stats = load_stats(collection)
    return Searcher(points, *(stats or (None, None)), distance=collection.meta()["distance"], parts=search_models(config))


def cmd_ingest(spark: SparkSession, config: Config, args: argparse.Namespace) -> int:
    docs = sources.read(spark, args.source, args.path)
    _, kind, fields = sources.SOURCES[args.source]
    result = ingest(docs, config, kind, ingest_models(config, args.contextual), fields)
    print(result.summary())
    for uri in result.error_uris:
        print(f"error: {uri}", file=sys.stderr)
    return int(result.errors > 0)


def _how(args: argparse.Namespace) -> dict:
    return {"use_rerank": args.rerank, "use_hybrid": args.hybrid, "multi": args.multi, "correct": args.corrective}


def cmd_search(spark: SparkSession, config: Config, args: argparse.Namespace) -> int:
    queries = spark.createDataFrame([(1, args.query)], "query_id long, query string")
    found = searcher(spark, config).search(queries, args.top, query_filter=json.loads(args.filter) if args.filter else None, **_how(args))
    for r in found.orderBy("rank").collect():
        print(f"{r['rank']}. [{r['score']:.3f}] {r['title']} ({r['source_uri']})\n   {r['text']}")
    return 0


def cmd_eval_gen(spark: SparkSession, config: Config, args: argparse.Namespace) -> int:
    points = Collection(spark, config.store.path, config.collection).points()
    model = text_model(config, config.eval.gen_model)
    writer = client.question_writer(model) if model else models.leading_questions
    golden, failed = evalrun.make_golden(reconstruct(points), writer, per_doc=args.per_doc or config.eval.per_doc_n)
    evalrun.save_golden(golden, args.golden or config.eval.golden_path.format(collection=config.collection))
    print(f"queries={golden.count()} failed={failed.count()}")
    return 0


def cmd_eval(spark: SparkSession, config: Config, args: argparse.Namespace) -> int:
    golden = evalrun.load_golden(spark, args.golden or config.eval.golden_path.format(collection=config.collection))
    ks = [int(k) for k in args.k.split(",")] if args.k else list(config.eval.k_values)
    found = searcher(spark, config)
    report = evalrun.run(golden, lambda q, top: found.search(q, top, **_how(args)), ks, config.collection, rerank=args.rerank, hybrid=args.hybrid, multi=args.multi, corrective=args.corrective)
    print(json.dumps({k: v for k, v in asdict(report).items() if k != "per_query"}))
    if args.save:
        evalrun.save_report(report, args.save)
    if args.baseline:
        print(json.dumps(evalrun.compare(evalrun.load_report(args.baseline), report)))
    return 0


def cmd_status(spark: SparkSession, config: Config, args: argparse.Namespace) -> int:
    current = state.latest(state.StateStore(spark, f"{config.state.path.rstrip('/')}/log").log())
    for r in state.counts(current, config.collection).collect():
        print(f"{r['state']}: {r['n']}")
    for r in state.recent_errors(current, config.collection, 20).collect():
        print(f"error: {r['uri']}: {r['error']}")
    return 0


def cmd_collections(spark: SparkSession, config: Config, args: argparse.Namespace) -> int:
    print("\n".join(collections(spark, config.store.path)))
    return 0


def cmd_serve(spark: SparkSession, config: Config, args: argparse.Namespace) -> int:
    from siltstone.service import Service

    Service(spark, config).serve()
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siltstone")
    top.add_argument("--config", default="siltstone.yaml")
    top.add_argument("--collection")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("ingest")
    p.add_argument("path")
    p.add_argument("--source", default="files", choices=sorted(sources.SOURCES))
    p.add_argument("--gate", action="store_true")
    p.add_argument("--contextual", action="store_true")
    p.set_defaults(run=cmd_ingest)

    def search_options(p: argparse.ArgumentParser) -> None:
        p.add_argument("--rerank", action="store_true")
        p.add_argument("--hybrid", action="store_true")
        p.add_argument("--multi", type=int, nargs="?", const=-1, default=0)
        p.add_argument("--corrective", action="store_true")

    p = sub.add_parser("search")
    p.add_argument("query")
    p.add_argument("--top", type=int, default=5)
    p.add_argument("--filter", help="JSON filter: must, should, must_not")
    search_options(p)
    p.set_defaults(run=cmd_search)
    p = sub.add_parser("eval-gen")
    p.add_argument("--per-doc", type=int)
    p.add_argument("--golden")
    p.set_defaults(run=cmd_eval_gen)
    p = sub.add_parser("eval")
    for name in ("--golden", "--k", "--save", "--baseline"):
        p.add_argument(name)
    search_options(p)
    p.set_defaults(run=cmd_eval)
    sub.add_parser("status").set_defaults(run=cmd_status)
    sub.add_parser("collections").set_defaults(run=cmd_collections)
    sub.add_parser("serve").set_defaults(run=cmd_serve)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    config = Config.load(args.config)
    if args.collection:
        config = replace(config, collection=args.collection)
    if getattr(args, "gate", False):
        config = replace(config, gate_enabled=True)
    if getattr(args, "multi", 0) == -1:
        args.multi = config.multi_query.n
    return args.run(spark or session(), config, args)


if __name__ == "__main__":
    sys.exit(main())

"""``python -m tablesift.cli dedup|process|summarize|features|train|quantiles|config ...``"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import SparkSession

from tablesift.plans import corpus
from tablesift.plans.config import VERSIONS, config


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tablesift")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("dedup", help="write the dedup index of a corpus")
    one.add_argument("directory")
    one.add_argument("out")
    one.add_argument("--max-shards", type=int)
    one = commands.add_parser("process", help="filter and clean a corpus")
    one.add_argument("directory")
    one.add_argument("index")
    one.add_argument("out")
    one.add_argument("--version", default="v6", choices=sorted(VERSIONS))
    one.add_argument("--chunk", type=int)
    one.add_argument("--chunk-size", type=int, default=512)
    one.add_argument("--resume", action="store_true", help="chunk by chunk, each committed as a whole; goes on with those that aren't")
    one.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    one.add_argument("--manifest", help="where the manifest goes as Parquet")
    one.add_argument("--language", help="weights of a language model, for the names of columns")
    one.add_argument("--quality", help="trees that train has written, for versions with a threshold")
    one = commands.add_parser("summarize", help="features of tables in files")
    one.add_argument("out")
    one.add_argument("files", nargs="+")
    one = commands.add_parser("features", help="features of all tables in shards")
    one.add_argument("directory")
    one.add_argument("out")
    one = commands.add_parser("train", help="fit a quality model on features of low and of high quality, or on a label column")
    one.add_argument("out", help="folder of the model, the training set as CSV, the report and the run's settings")
    one.add_argument("--low", required=True, help="features of tables of low quality, or all features if --label is given")
    one.add_argument("--high", nargs="*", default=[])
    one.add_argument("--label", help="the column that says 0 or 1, such as whether a column is a target")
    one.add_argument("--names", nargs="*", help="features to use; all numeric columns otherwise")
    one.add_argument("--trials", type=int, default=1)
    one = commands.add_parser("quantiles", help="quantiles of a model's scores")
    one.add_argument("features")
    one.add_argument("model")
    one.add_argument("out")
    one.add_argument("--names", nargs="*")
    one = commands.add_parser("config", help="show a configuration")
    one.add_argument("version", choices=sorted(VERSIONS))
    args = parser.parse_args(argv)
    if args.command == "config":
        print(config(args.version).to_json())
        return
    spark = SparkSession.builder.appName("tablesift").getOrCreate()
    if args.command == "dedup":
        corpus.dedup(spark, args.directory, args.out, args.max_shards)
    elif args.command == "process":
        from tablesift.operators import trees
        from tablesift.operators.language_model import LanguageModel
        from tablesift.operators.summarize import features_of_tables

        language = LanguageModel.of_table(spark.read.parquet(args.language)) if args.language else None
        own = trees.quality_of(trees.load(spark, args.quality), features_of_tables) if args.quality else None
        if args.resume:
            only = None if args.chunk is None else [args.chunk]
            manifest = corpus.process_chunks(spark, args.directory, args.index, args.out, config(args.version), args.chunk_size, args.format, language, own, only)
        else:
            manifest = corpus.process(spark, args.directory, args.index, args.out, config(args.version), args.chunk, args.chunk_size, args.format, language, own)
        manifest.write.mode("overwrite").parquet(args.manifest or f"{args.out}-manifest")
    elif args.command == "features":
        from pyspark.sql import functions as F

        from tablesift.operators.dedup import content_hash
        from tablesift.operators.summarize import features_of_tables
        from tablesift.sources import arrow_tables, shards

        tables = shards.read_shards(spark, args.directory).select(content_hash(F.col("key")).alias("content_hash"), "arrow_bytes").dropDuplicates(["content_hash"])
        facts = arrow_tables.with_facts(tables).filter("error IS NULL").select(F.col("content_hash").alias("table_id"), "dtypes")
        features_of_tables(arrow_tables.cells(tables).withColumnRenamed("content_hash", "table_id"), facts).write.mode("overwrite").parquet(args.out)
    elif args.command == "train":
        _train(spark, args)
    elif args.command == "quantiles":
        from tablesift.operators import quality
        from tablesift.operators.summarize import score_quantiles

        features = spark.read.parquet(args.features)
        scores = quality.scored(features, quality.load(args.model), args.names or _numeric(features))
        score_quantiles(scores, "score").write.mode("overwrite").option("header", "true").csv(args.out)
    else:
        from pyspark.sql import functions as F

        from tablesift.operators.summarize import table_features
        from tablesift.sources.shards import read_file

        rows = [table_features(read_file(spark, f)).withColumn("table_id", F.lit(f)) for f in args.files]
        reduce(lambda a, b: a.unionByName(b), rows).write.mode("overwrite").parquet(args.out)


def _numeric(features) -> list[str]:
    return sorted(c for c, t in features.dtypes if t in ("double", "float", "int", "bigint"))


def _train(spark: SparkSession, args: argparse.Namespace) -> None:
    from pyspark.sql import functions as F

    from tablesift.operators import quality, search, trees
    from tablesift.operators.sampling import stratified_split
    from tablesift.sources import shards, sinks

    low, label = spark.read.parquet(args.low), args.label or "quality"
    rows = low if args.label else shards.labelled(low, [spark.read.parquet(h) for h in args.high])
    names = args.names or [c for c in _numeric(rows) if c != label]
    # The split is by a digest of the features, so it doesn't change when rows come in another order.
    keyed = rows.withColumn("__key", F.md5(F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]))))
    split = stratified_split(keyed, label, "__key")
    split.select(*names, F.col(label).cast("int").alias(label), "in_train").write.mode("overwrite").option("header", "true").csv(f"{args.out}/training")
    train = split.filter("in_train").drop("in_train")
    if args.trials > 1:
        found = search.search(train, names, label, "__key", args.trials)
        model, history = found.model, found.history()
    else:
        model, history = quality.fit(train, names, label), []
    scores = quality.scored(split.filter("NOT in_train"), model, names)
    result = quality.evaluate(scores, label).first().asDict()
    quality.report(scores, label).coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{args.out}/report")
    path = quality.save(model, args.out)
    # The same as plain trees, for ``process``.
    own = path.replace("/model-", "/trees-")
    trees.save(trees.compiled(model, names), spark, own)
    sinks.write_run(f"{args.out}/run.json", model=path, trees=own, names=names, label=label, trials=args.trials, history=history, importances=quality.importances(model, names), **result)


if __name__ == "__main__":
    main()

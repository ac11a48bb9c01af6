"""Command line: python -m adlens {load-log,explore,create-features,train} ..."""

from __future__ import annotations

import argparse

from adlens.plans import exploration, feature_table, training
from adlens.session import build_session
from adlens.sources import tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="adlens")
    commands = top.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load-log", help="normalise a raw click log")
    load.add_argument("--input", required=True)
    load.add_argument("--output", required=True)
    load.add_argument("--n-rows", type=int)
    load.add_argument("--sample-frac", type=float)

    explore = commands.add_parser("explore", help="profile an impressions table")
    explore.add_argument("--input", required=True)
    explore.add_argument("--output", help="folder for the reports; printed when left out")
    explore.add_argument("--approximate", action="store_true")

    create = commands.add_parser("create-features", help="build the feature table")
    create.add_argument("--input", required=True)
    create.add_argument("--output", required=True)
    create.add_argument("--state", help="folder for the fitted state")
    create.add_argument("--target-col", default="clicked")
    create.add_argument("--row-id", default="impression_id")
    create.add_argument("--no-basic", action="store_true")
    create.add_argument("--no-advanced", action="store_true")
    create.add_argument("--no-selection", action="store_true")
    create.add_argument("--compat", action="store_true")
    create.add_argument("--sample-frac", type=float)

    train = commands.add_parser("train", help="train and compare models")
    train.add_argument("--input", required=True)
    train.add_argument("--output-dir", required=True)
    train.add_argument("--models", nargs="+", default=["logistic", "xgboost", "lightgbm"])
    train.add_argument("--test-size", type=float, default=0.2)
    train.add_argument("--val-size", type=float, default=0.2)
    train.add_argument("--target-col", default="clicked")
    train.add_argument("--row-id", default="impression_id")
    train.add_argument("--random-state", type=int, default=42)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    if args.command == "load-log":
        df = tables.load_and_prepare(spark, args.input, n_rows=args.n_rows, sample_frac=args.sample_frac)
        print(tables.write_table_sized(df, args.output))
    elif args.command == "explore":
        reports = exploration.explore(tables.read_table_auto(spark, args.input), not args.approximate)
        for name, report in reports.items():
            if args.output:
                tables.write_report(report, f"{args.output}/{name}.csv")
            else:
                print(name)
                report.show(truncate=False)
    elif args.command == "create-features":
        options = feature_table.FeatureOptions(
            target=args.target_col, row_id=args.row_id, compat=args.compat,
            create_basic=not args.no_basic, create_advanced=not args.no_advanced,
            apply_selection=not args.no_selection,
            high_card_columns=None if args.compat else ("user_id", "ad_id"),
        )
        feature_table.create_features(spark, args.input, args.output, options, args.sample_frac, args.state)
    else:
        df = tables.read_table(spark, args.input)
        result = training.train_models(
            df, args.models, args.target_col, args.row_id, args.test_size, args.val_size, args.random_state
        )
        result.save(args.output_dir)
        result.comparison().show()


if __name__ == "__main__":
    main()

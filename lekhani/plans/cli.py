"""Command line: one stage of the pipeline from paths to paths."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from lekhani import config as cfg
from lekhani.functions import keywords
from lekhani.plans import stages
from lekhani.sources import readers, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lekhani")
    p.add_argument("--config", help="flat JSON file of thresholds")
    p.add_argument("--language", help="use the built-in settings of a language")
    p.add_argument("--mode", choices=["crawl", "ocr", "asr"], default="crawl")
    sub = p.add_subparsers(dest="stage", required=True)

    def stage(name: str, inputs: list[str], outputs: list[str]) -> argparse.ArgumentParser:
        s = sub.add_parser(name)
        for arg in (*inputs, *outputs):
            s.add_argument(f"--{arg}", required=True)
        s.add_argument("--path_batched", type=cfg.as_bool, default=False, help="the input path is a list of paths")
        return s

    s = stage("JSON2ParquetStage", ["json_glob_path", "language_name"], ["j2p_parquet_output_path"])
    s.add_argument("--j2p_is_multiline", type=cfg.as_bool, default=True)
    stage("ExtractTextStage", ["te_parquets_path"], ["te_output_path"])
    s = stage("DocCleanStage", ["doc_df_parquets_path"], ["cleaned_doc_output_path"])
    s.add_argument("--doc_clean_additional_cols_to_use", type=cfg.as_list, default=["url", "source", "language"])
    s.add_argument("--use_symbol_filter", type=cfg.as_bool, default=True)
    s.add_argument("--save_symbol_heavy_docs", type=cfg.as_bool, default=True)
    s.add_argument("--symbol_filter_output_path")
    s = stage("LIDStage", ["lid_df_parquets_path", "language_table"], ["doc_lid_output_path"])
    s.add_argument("--lid_additional_cols", type=cfg.as_list, default=["url", "source", "language"])
    s = stage("AnalysisStage", ["analysis_df_parquets_path"], ["line_stats_output_path", "doc_stats_output_path", "analysis_output_path"])
    s.add_argument("--keyword_glob")
    s = stage("FlaggingAndFilteringStage", ["doc_stats_parquets_path"], ["filtered_doc_stats_output_path"])
    s.add_argument("--save_nsfw_data", type=cfg.as_bool, default=True)
    s.add_argument("--nsfw_output_path")
    s = stage("DocumentRemovalStage", ["analysis_out_path", "doc_stats_path"], ["filtered_docs_path"])
    s.add_argument("--doc_removal_join_col", default="doc_id")
    return p


def settings(args: argparse.Namespace) -> cfg.Config:
    if args.config:
        return cfg.load(args.config)
    build = cfg.for_scans if args.mode == "ocr" else cfg.for_language
    return build(args.language or "english")


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    """Runs the stage named on the command line."""
    args = parser().parse_args(argv)
    config = settings(args)

    def load(path: str) -> DataFrame:
        return readers.read_manifest(spark, path) if args.path_batched else readers.read_parquet(spark, path)

    if args.stage == "JSON2ParquetStage":
        sinks.write_parquet(stages.json_to_parquet(spark, args.json_glob_path, args.language_name, args.mode, args.j2p_is_multiline), args.j2p_parquet_output_path)
    elif args.stage == "ExtractTextStage":
        sinks.write_parquet(stages.extract_text(load(args.te_parquets_path)), args.te_output_path)
    elif args.stage == "DocCleanStage":
        cleaned, heavy = stages.clean_documents(load(args.doc_df_parquets_path), args.doc_clean_additional_cols_to_use, config, args.use_symbol_filter)
        sinks.write_parquet(cleaned, args.cleaned_doc_output_path)
        if args.save_symbol_heavy_docs and args.symbol_filter_output_path:
            sinks.write_parquet(heavy, args.symbol_filter_output_path)
    elif args.stage == "LIDStage":
        codes = readers.language_codes(readers.read_parquet(spark, args.language_table))
        found = stages.identify_language(load(args.lid_df_parquets_path), stages.default_detectors(), codes, ["doc_id", *args.lid_additional_cols, "text"])
        sinks.write_by_language(found, args.doc_lid_output_path)
    elif args.stage == "AnalysisStage":
        lists = keywords.read_lists(spark, args.keyword_glob) if args.keyword_glob else None
        out = stages.analyse(load(args.analysis_df_parquets_path), lists, config)
        sinks.write_parquet(out.lines, args.line_stats_output_path)
        sinks.write_by_language(out.stats, args.doc_stats_output_path)
        sinks.write_by_language(out.docs, args.analysis_output_path)
    elif args.stage == "FlaggingAndFilteringStage":
        kept, heavy = stages.flag_and_filter(load(args.doc_stats_parquets_path), config)
        sinks.write_parquet(kept, args.filtered_doc_stats_output_path)
        if args.save_nsfw_data and args.nsfw_output_path:
            sinks.write_parquet(heavy, args.nsfw_output_path)
    else:
        docs = load(args.analysis_out_path)
        sinks.write_parquet(stages.remove_documents(docs, readers.read_parquet(spark, args.doc_stats_path), args.doc_removal_join_col), args.filtered_docs_path)

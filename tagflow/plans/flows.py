"""The three main flows, as compositions of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tagflow.operators import catalog as C
from tagflow.operators import evaluation as E
from tagflow.operators import joins as J
from tagflow.operators import sampling as S
from tagflow.operators import summaries as M
from tagflow.operators import tagging as T


def dataset_build(catalog: DataFrame, classes: Sequence[str], overrides: Mapping[str, str], frac: float = 0.2, seed: int = 42) -> dict[str, DataFrame]:
    """Folders to a labelled, split manifest with class weights of its training rows; and the duplicates to look at."""
    manifest = C.manifest_from_folders(catalog, overrides)
    split = S.stratified_split(manifest.where(manifest.Class.isin(*classes)), "Class", frac, seed)
    return {
        "duplicates": C.duplicate_stems(catalog), "manifest": split,
        "class_weights": S.class_weights(S.select_split(split, "train"), "Class", classes), "skipped": C.manifest_duplicates(catalog, overrides)}


def tagging_review(answers: DataFrame, catalog: DataFrame, descriptions: DataFrame, toes: Sequence[str], heels: Sequence[str], construction: list[str], embellishment: list[str]) -> dict[str, DataFrame]:
    """Stored answers to tags and review cards."""
    tags = T.parse_tags(answers, toes, heels, [*construction, *embellishment])
    return {"tags": tags, "cards": M.review_cards(tags, descriptions, catalog, construction, embellishment)}


def evaluation(gt: DataFrame, pred: DataFrame, aliases: DataFrame) -> dict[str, DataFrame]:
    """Truth and predictions to a report on canonical terms, top confusions and wrong rows."""
    pairs = E.taxonomy_pairs(J.join_gt_pred(gt, pred), aliases)
    counts = E.pair_counts(pairs, "gt_norm", "pred_norm")
    return {"pairs": pairs, "report": E.classification_report(counts), "confusions": E.top_confusions(counts), "taxonomy": E.taxonomy_accuracy(pairs), "wrong": E.misclassified(pairs)}

"""The advanced feature block, and the two flows beside the semantic one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import numeric, text
from ..operators import cleaning, distribution, evaluation, selection, training
from ..operators.distribution import QuantileTransform
from ..operators.matrix import finite_or_zero, numeric_columns
from ..sources.workspace import cut
from .blocks import KEY, LABEL, TraditionalBlock


@dataclass
class AdvancedBlock:
    """Rating, text-quality and interaction features, made normal by their quantiles, of which the k
    with the strongest linear relation to the rating stay."""

    k: int = selection.DEFAULT_K
    edges: list[float] | None = None
    flags: dict | None = None
    quantiles: QuantileTransform | None = None
    chosen: list[str] | None = None

    def raw(self, clean: DataFrame) -> DataFrame:
        """(book_id, average_rating, all numeric features), finite everywhere; one projection."""
        features = {
            **numeric.engagement(),
            "popularity_percentile": distribution.decile_bucket("ratings_count", self.edges),
            **self.flags,
            **numeric.era_flags(),
            **numeric.length_quality(),
            **text.text_readability(),
            **text.lexicon_sentiment(),
            **text.lexical_diversity(),
            "quality_word_count": text.quality_word_count(),
            "estimated_age": text.estimated_age_title(),
            **numeric.interactions(text.quality_word_count(), text.lexicon_sentiment()["desc_sentiment"]),
        }
        wide = clean.withColumns(features)
        names = numeric_columns(wide, exclude=[KEY, LABEL])
        return wide.select(KEY, LABEL, *[finite_or_zero(F.col(c).cast("double")).alias(c) for c in names])

    def fit(self, clean: DataFrame) -> AdvancedBlock:
        self.edges = distribution.decile_edges(clean)
        self.flags = distribution.quantile_flags(clean)
        raw = cut(self.raw(clean), "advanced-raw")
        names = numeric_columns(raw, exclude=[KEY, LABEL])
        self.quantiles = distribution.fit_quantile_transform(raw, names)
        best = selection.select_k_best(cut(self.quantiles.normal(raw), "advanced"), names, LABEL, self.k)
        kept = {r.feature for r in best.collect()}
        self.chosen = [c for c in names if c in kept]
        return self

    def transform(self, clean: DataFrame) -> DataFrame:
        """(book_id, average_rating, chosen features...)."""
        if self.chosen is None:
            raise ValueError("the block must be fitted before it transforms new rows")
        normal = self.quantiles.normal(self.raw(clean), self.chosen)
        return normal.select(KEY, LABEL, *[finite_or_zero(F.col(c)).alias(c) for c in self.chosen])


def train_advanced(books: DataFrame, name: str = "random_forest") -> training.Trained:
    """Clean, drop outlying ratings, split, build the advanced block on training rows, and fit the
    named preset on the power-transformed rating."""
    chosen = cleaning.category_filter(books)
    fitted = cleaning.fit_cleaning(evaluation.train_test_split(chosen)[0])
    clean = cut(cleaning.iqr_filter(fitted.transform(chosen)), "advanced-clean")
    cleaning.require_min_rows(clean)
    train, test = evaluation.train_test_split(clean)
    block = AdvancedBlock().fit(train)
    kind, params = training.PRESETS[name]
    rows = [training.assemble(cut(block.transform(part), "advanced-part"), block.chosen, [KEY, LABEL]) for part in (train, test)]
    done, _ = training.evaluate_on_transformed_target(name, kind, *rows, **params)
    return done


def train_configured(books: DataFrame, name: str = "linear", folds: int = 5):
    """Clean, keep ratings from 1 to 5, split, build the traditional block on training rows, fit the
    named preset: (trained, one-row cross-validation, importances or None)."""
    chosen = cleaning.category_filter(books)
    fitted = cleaning.fit_cleaning(evaluation.train_test_split(chosen)[0])
    clean = cut(cleaning.rating_range_filter(fitted.transform(chosen)), "config-clean")
    cleaning.require_min_rows(clean, lx.MIN_TRAINING_ROWS)
    block = TraditionalBlock().fit(evaluation.train_test_split(clean)[0])
    columns = block.features()
    rows = cut(training.assemble(block.transform(clean, [LABEL]), columns, [KEY, LABEL]), "config-rows")
    train, test = evaluation.train_test_split(rows)
    done = training.evaluate(name, training.preset(name, train), train, test)
    scores = training.cross_validate_preset(name, train, folds)
    trees = hasattr(done.model, "featureImportances")
    importance = training.feature_importance(books.sparkSession, done.model, columns) if trees else None
    return done, scores, importance

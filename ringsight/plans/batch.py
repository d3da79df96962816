"""The batch run: load, score transactions, score clusters, decide, log, measure.

Every stage that more than one later stage reads is written once to the shared folder (`materialize`); the rest stays lazy.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ringsight.config import DEFAULT, Settings
from ringsight.operators import audit, communities, components, evaluate, fusion, links, model, scoring
from ringsight.operators.features import extract_features
from ringsight.operators.rules import evaluate_rules
from ringsight.session import materialize
from ringsight.sources import tables


class BatchRun:
    """The stages of one run over one pair of tables, each built when first asked for."""

    def __init__(self, accounts: DataFrame, transactions: DataFrame, cfg: Settings = DEFAULT):
        self.accounts = accounts
        self.transactions = transactions
        self.cfg = cfg

    # layer 1
    @cached_property
    def features(self) -> DataFrame:
        return materialize(evaluate_rules(extract_features(self.transactions, self.accounts, self.cfg), self.cfg), "features")

    @cached_property
    def model(self) -> PipelineModel:
        return model.train(self.features, self.cfg)

    @cached_property
    def layer1(self) -> DataFrame:
        """Scores of the held-out share."""
        _, held_out = model.split(self.features, self.cfg)
        return materialize(model.predict(held_out, self.model, self.cfg), "layer1")

    # layer 2
    @cached_property
    def members(self) -> DataFrame:
        return materialize(links.memberships(self.accounts, self.transactions), "memberships")

    @cached_property
    def edges(self) -> DataFrame:
        return materialize(links.weighted_edges(self.accounts, self.transactions, self.members, self.cfg), "edges")

    @cached_property
    def components(self) -> DataFrame:
        return materialize(components.account_components(self.accounts, self.members, self.cfg), "components")

    @cached_property
    def mapping(self) -> DataFrame:
        """The published account-to-cluster table, after refinement."""
        return materialize(communities.refine(self.edges, self.components, self.cfg), "mapping")

    def summary(self, mapping: DataFrame) -> DataFrame:
        signals = components.shared_signals(mapping, self.accounts, self.members, self.cfg)
        return components.cluster_summary(mapping, signals)

    def score(self, mapping: DataFrame) -> DataFrame:
        return scoring.score_clusters(mapping, self.summary(mapping), self.accounts, self.transactions, self.cfg)

    @cached_property
    def scored(self) -> DataFrame:
        return materialize(self.score(self.mapping), "scored")

    # decisions
    @cached_property
    def fused(self) -> DataFrame:
        lookup = fusion.ring_lookup(self.mapping, self.scored)
        return materialize(fusion.fuse_scores(self.layer1, self.transactions, lookup, self.cfg, evidence=True), "fused")

    @cached_property
    def log(self) -> DataFrame:
        return audit.log_entries(self.fused, self.layer1, self.scored)

    @cached_property
    def _labelled(self) -> DataFrame:
        return materialize(evaluate.labelled(self.log, self.transactions), "labelled")

    def labelled(self) -> DataFrame:
        """Log entries with label and account, joined once for all that is measured."""
        return self._labelled

    def write(self, folder: str) -> None:
        """Publish model, clusters, audit log and metrics."""
        tables.save_model(self.model, f"{folder}/model")
        lists = components.member_lists(self.mapping)
        tables.write_clusters(scoring.cluster_output(self.scored, lists), f"{folder}/clusters")
        tables.write_table(self.mapping, f"{folder}/mapping")
        tables.replace_audit(self.log, f"{folder}/audit_log")
        log = tables.read_audit(self.accounts.sparkSession, f"{folder}/audit_log")
        tables.publish_audit(log, f"{folder}/audit_index", uuid.uuid4().hex, self.cfg)
        rows = materialize(evaluate.labelled(log, self.transactions), "labelled")
        tables.write_metrics(evaluate.uplift(rows, self.cfg), f"{folder}/metrics")
        report = evaluate.evaluation_table(rows, self.accounts, self.mapping, self.scored, self.cfg)
        tables.write_table(report, f"{folder}/evaluation")

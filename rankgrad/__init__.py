"""rankgrad: link ranking and data-parallel training data work on Spark.

The public API, by family:

* link ranking: ``read_lines``, ``read_link_files``, ``edges_from_text``,
  ``drop_comments``, ``parse_edges``, ``clean_links``, ``union_sources``,
  ``reverse_edges``, ``out_degree``, ``weight_edges``, ``initial_ranks``,
  ``contributions``, ``rank_step``, ``adjacency``, ``top_ranks``,
  ``pagerank``, ``write_ranks``, ``partition_profile``;
* training: ``read_vectors``, ``split``, ``normalize``, ``random_crop``,
  ``random_flip``, ``with_positions``, ``balanced_split``, ``assign_shards``,
  ``assign_batches``, ``scores``, ``with_loss``, ``with_prediction``,
  ``shard_gradients``, ``mean_gradients``, ``train_softmax``, ``evaluate``,
  ``train_and_evaluate``, ``write_step_log``, ``read_step_log``,
  ``summarise_steps``, ``every_nth``.
"""

from .functions.clean import clean_links, drop_comments, parse_edges, union_sources
from .functions.features import normalize, random_crop, random_flip
from .functions.model import Params, scores, with_loss, with_prediction
from .operators.gradients import mean_gradients, shard_gradients
from .operators.graph import (adjacency, contributions, initial_ranks, out_degree,
                              partition_profile, rank_step, reverse_edges, top_ranks,
                              weight_edges)
from .operators.sample import (assign_batches, assign_shards, balanced_split, every_nth,
                               with_positions)
from .operators.steps import summarise_steps
from .plans.pagerank import pagerank
from .plans.train import evaluate, split, train_and_evaluate, train_softmax
from .sources.steplog import read_step_log, write_step_log
from .sources.text import edges_from_text, read_lines, read_link_files, write_ranks
from .sources.vectors import read_vectors

__all__ = [
    "Params", "adjacency", "assign_batches", "assign_shards", "balanced_split",
    "clean_links", "contributions", "drop_comments", "edges_from_text", "evaluate",
    "every_nth", "initial_ranks", "mean_gradients", "normalize", "out_degree",
    "pagerank", "parse_edges", "partition_profile", "random_crop", "random_flip",
    "rank_step", "read_lines", "read_link_files", "read_step_log", "read_vectors",
    "reverse_edges", "scores", "shard_gradients", "split", "summarise_steps",
    "top_ranks", "train_and_evaluate", "train_softmax", "union_sources",
    "weight_edges", "with_loss", "with_positions", "with_prediction",
    "write_ranks", "write_step_log",
]

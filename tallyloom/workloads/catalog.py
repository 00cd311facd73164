"""Imports every module that registers queries."""

from tallyloom.workloads import q_counts  # noqa: F401
from tallyloom.workloads import q_qc  # noqa: F401
from tallyloom.workloads import q_hvg  # noqa: F401
from tallyloom.workloads import q_ranks  # noqa: F401
from tallyloom.workloads import q_pseudobulk  # noqa: F401
from tallyloom.workloads import q_markers  # noqa: F401
from tallyloom.workloads import q_models  # noqa: F401
from tallyloom.workloads import q_labels  # noqa: F401
from tallyloom.workloads import q_tags  # noqa: F401
from tallyloom.workloads import q_ambient  # noqa: F401
from tallyloom.workloads import q_embed  # noqa: F401
from tallyloom.workloads import q_tables  # noqa: F401
from tallyloom.workloads import q_checks  # noqa: F401
from tallyloom.workloads import q_stages  # noqa: F401

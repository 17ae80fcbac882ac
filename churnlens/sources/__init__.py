"""Sources (landed files, driver tables) and sinks."""

from churnlens.sources.demo import AS_OF, demo_profiles, demo_repos, load_tables  # noqa: F401
from churnlens.sources.files import (  # noqa: F401
    load_feature_matrix, load_latent, read_profiles, read_raw_users, read_repos, save_latent, write_table,
)

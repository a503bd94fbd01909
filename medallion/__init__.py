"""Spark-native medallion analytics: Bronze snapshots -> Silver tables -> Gold marts.

Every public operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; nothing between read and write passes through
the driver except small, bounded check results.
"""

__version__ = "0.1.0"

from .operators.ranking import rank_by, top_k  # noqa: E402,F401
from .operators.sequence import (dedup_latest, last_n_per_group, running_stats)  # noqa: E402,F401
from .operators.two_sided import two_sided  # noqa: E402,F401
from .plans.dashboards import (form_summary, player_goal_share, season_goals,  # noqa: E402,F401
                               top_teams_by_goals)
from .plans.gold import (rolling_form, standings, standings_totals, team_form,  # noqa: E402,F401
                         top_scorers)
from .plans.ingest import (bronze_ingest, new_snapshots, publish_gold,  # noqa: E402,F401
                           run_log_summary, season_index_ingest)
from .plans.jobs import gold_job, silver_job  # noqa: E402,F401
from .plans.quality import (MATCH_CHECKS, PLAYER_CHECKS, STAGING_TESTS, with_severity,  # noqa: E402,F401
                            TEAM_CHECKS, Check, ColumnTest, QualityGateError, check_results,
                            quality_gate, run_tests)
from .plans.silver import silver_matches, silver_players, silver_teams  # noqa: E402,F401
from .session import build_session, checkpoint_dir, drop_scratch_tables  # noqa: E402,F401
from .sources.bronze import latest_documents, read_documents, records  # noqa: E402,F401
from .sources.layers import read_silver, write_silver  # noqa: E402,F401

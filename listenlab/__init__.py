"""listenlab: Spark-native analytics for music-listening events.

Every operation is a function from DataFrame to DataFrame written with Spark's
built-in expressions: no Python UDF. Operators are lazy; only functions that write run jobs.
"""

from .operators.clean import clean_listens
from .operators.counts import (
    artist_state_listens,
    artist_state_listens_all,
    artists_over,
    bottom_artists,
    states_list,
    top_artists,
    top_artists_all,
    top_free_songs,
    top_n_by_listens,
    top_paid_songs,
    top_songs,
    top_songs_all,
)
from .operators.kpis import kpi_cards, kpis
from .operators.maps import map_stats, map_stats_all, state_map, state_map_all
from .operators.mix import subscription_mix, subscription_mix_all
from .operators.monthly import monthly_listening, monthly_listening_all, monthly_seconds, monthly_seconds_all
from .operators.subscriptions import effective_subscription, paid_users
from .operators.summaries import (
    bottom_artists_prompt,
    map_summary_prompt,
    monthly_stats,
    monthly_summary_prompt,
    qa_context,
    qa_prompt,
    table_prompt,
)
from .sources.files import read_clean, read_listens, write_clean, write_listens
from .sources.schema import CLEAN_COLUMNS, LISTEN_SCHEMA, NATIONWIDE, US_STATES, us_states

__all__ = [name for name in dir() if not name.startswith("_")]

from checks import q_routes  # noqa: F401
from checks import q_enrich  # noqa: F401
from checks import q_validate  # noqa: F401
from checks import q_joins  # noqa: F401
from checks import q_tables  # noqa: F401
from checks import q_jobs  # noqa: F401
from checks import q_io  # noqa: F401
from checks.registry import check_whole

for _key in ("profile_users", "unpivot_traits", "trait_comparison", "match_rate", "seg_vs_cdp_join"):
    check_whole(_key)

from tierkit.plans.watermark import compact_watermark, read_watermark, reset_watermark, \
    write_watermark  # noqa: F401
from tierkit.plans.flows import (  # noqa: F401
    GoldConfig, SilverConfig, bronze_to_silver, land_snapshot, run_all, silver_to_gold)

from adpulse.functions.constants import *  # noqa: F401,F403
from adpulse.functions.columns import *  # noqa: F401,F403

from berthline.functions.dates import *  # noqa: F401,F403
from berthline.functions.numbers import *  # noqa: F401,F403
from berthline.functions.text import *  # noqa: F401,F403

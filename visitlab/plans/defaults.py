"""Parameter sets used by the registered queries (fixed, so results are
reproducible and comparable with the SQL oracle)."""

from visitlab.params import TaskParams

TASK_ID = "task-0001"
SEED = "visitlab"
K_EXTRACT = 150
K_EXTRACT_LARGE = 600

DEFAULT = TaskParams(start_date="2024-01-01", end_date="2024-01-31",
                     start_age=20, end_age=50, task_id=TASK_ID,
                     target_page_flow="1,2,3,4,5,6,7")
IN_RANGE = DEFAULT.replace(start_date="2024-01-05", end_date="2024-01-20")
ALL_PARAMS = DEFAULT.replace(
    professionals="MACHINERY,HOUSEHOLD,BUILDING,AUTOMOBILE",
    cities=",".join(f"city{i}" for i in range(13)),
    sex="male",
    keywords="kw1,kw2,kw3",
    category_ids=",".join(str(i) for i in range(30)),
)

"""Values the tests share; a module of its own, since each test folder has a ``conftest``."""

from datetime import datetime

SF_DIR = "/root/testdata/sf0.001"
NOW = datetime(2024, 1, 31, 12, 0)

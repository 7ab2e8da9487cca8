"""Page getters used by the paged-source tests (shipped to workers with addPyFile)."""

import json
import os


def flaky_pages(key, day, page, params):
    """Fails the first ``params['fail']`` calls (counted in a file), then serves files."""
    counter = os.path.join(params["root"], f"calls-{key}-{day}-{page}")
    n = int(open(counter).read()) if os.path.exists(counter) else 0
    with open(counter, "w") as f:
        f.write(str(n + 1))
    if n < params["fail"]:
        raise ConnectionError("transient")
    path = os.path.join(params["root"], key, day, f"{page}.json")
    return json.load(open(path)) if os.path.exists(path) else []


def counting_pages(key, day, page, params):
    """Serves files like file_pages and leaves one marker file per call."""
    marker = os.path.join(params["root"], "calls", f"{key}-{day}-{page}")
    os.makedirs(os.path.dirname(marker), exist_ok=True)
    open(marker, "w").close()
    path = os.path.join(params["root"], key, day, f"{page}.json")
    return json.load(open(path)) if os.path.exists(path) else []

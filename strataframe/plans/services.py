"""External services behind callables: JSON requests, waiting with a deadline, filling a workflow graph, preflights.

Nothing here is called unless a client is passed in; clocks and sleeps are arguments, so that tests need no service.
"""

from __future__ import annotations

import copy
import json
import os
import re
import shutil
import subprocess
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Mapping

import numpy as np
import pyarrow.fs as pafs

from strataframe.functions import raster
from strataframe.sources.sinks import write_atomic
from strataframe.sources.tables import read_text


def request_json(url: str, body: object = None, timeout: float = 60, token: str | None = None):
    """The JSON answer of a GET, or of a POST of body; an error status raises with the start of its text."""
    headers = {"Authorization": f"Bearer {token}"} if token else {}
    data = None
    if body is not None:
        data, headers["Content-Type"] = json.dumps(body).encode(), "application/json"
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data, headers), timeout=timeout) as answer:
            return json.loads(answer.read() or b"{}")
    except urllib.error.HTTPError as e:
        raise RuntimeError(f"HTTP {e.code} {e.reason} for {url}: {e.read().decode(errors='replace')[:2000]}") from e


def wait_for(poll: Callable[[], object], timeout: float, every: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
    """The first answer of poll that is not None; TimeoutError after the deadline, with one last poll at it."""
    deadline = clock() + timeout
    while (answer := poll()) is None:
        if clock() >= deadline:
            raise TimeoutError(f"nothing within {timeout:g} s")
        sleep(every)
    return answer


def run_job(submit: Callable[[], str], history: Callable[[str], dict | None], interrupt: Callable[[str], None], timeout: float, **clocks) -> dict:
    """Submits a job and waits for its entry; a job that is given up, by deadline or by hand, is interrupted first."""
    job = submit()
    try:
        entry = wait_for(lambda: history(job), timeout, **clocks)
    except (TimeoutError, KeyboardInterrupt):
        try:
            interrupt(job)
        except Exception:  # what made us give up counts, not that stopping failed
            pass
        raise
    status = entry.get("status", {})
    if status.get("status_str") != "success":
        raise RuntimeError(f"the job failed: {status.get('messages', status)}")
    return entry


def filled_graph(template: dict, values: dict[tuple[str, str], object]) -> dict:
    """A copy of a graph of nodes with inputs set; a node that the template lacks is an error."""
    graph = copy.deepcopy(template)
    for (node, name), value in values.items():
        if node not in graph:
            raise ValueError(f"the graph has no node {node}")
        graph[node].setdefault("inputs", {})[name] = value
    return graph


def missing(required: Iterable[str], has: Callable[[str], bool]) -> list[str]:
    """What of the required is not there; a check that fails counts as not there."""

    def there(name: str) -> bool:
        try:
            return bool(has(name))
        except (OSError, ValueError, RuntimeError):
            return False

    return [r for r in required if not there(r)]


def answer_text(response: dict) -> str:
    """The text of a chat answer; a cut-off or empty one is an error."""
    choice = response["choices"][0]
    if choice.get("finish_reason") == "length":
        raise ValueError("the answer was cut off")
    text = choice["message"].get("content")
    if not isinstance(text, str) or not text.strip():
        raise ValueError("the answer has no text")
    return text.strip()


def memory_available_gb(path: str = "/proc/meminfo") -> float:
    with open(path) as f:
        return next(int(line.split()[1]) for line in f if line.startswith("MemAvailable:")) / 2**20


def load_graph(uri: str, settings: dict[tuple[str, str], object] | None = None) -> dict:
    """The graph in a template file, read anew, with settings put in; a file without one is an error."""
    text = read_text(uri)
    if text is None:
        raise ValueError(f"{uri}: there is no such template")
    document = json.loads(text)
    if not isinstance(document.get("prompt"), dict):
        raise ValueError(f"{uri}: the template has no graph")
    return filled_graph(document["prompt"], settings or {})


def is_up(probe: Callable[[], object]) -> bool:
    """Whether a service answers at all."""
    try:
        probe()
    except (OSError, ValueError, RuntimeError):
        return False
    return True


def free_models(post: Callable[[dict], object]) -> bool:
    """Asks a service to let go of its models and memory; whether it could be asked."""
    return is_up(lambda: post({"unload_models": True, "free_memory": True}))


def staged(folder: str, name: str, pictures: Mapping[str, np.ndarray]) -> dict[str, str]:
    """File names of the pictures, written whole into a service's input folder, by what they are."""
    out = {what: f"{name}-{what}.png" for what in pictures}
    for what, picture in pictures.items():
        write_atomic(f"{folder}/{out[what]}", raster.png_encode(picture))
    return out


def render_window(folder: str, name: str, pictures: Mapping[str, np.ndarray], template: dict, places: Mapping[str, tuple[str, str]], run: Callable[[dict], dict]) -> dict:
    """One window: pictures staged, their names put into the graph at places, the graph run to its end."""
    files = staged(folder, name, pictures)
    return run(filled_graph(template, {places[what]: file for what, file in files.items()}))


def sweep(folder: str, key: str) -> int:
    """Deletes what renders of an item have left in a folder, key_label_00001_.png and the like; how many there were.

    Files of other items stay, also of those whose keys start alike.
    """
    fs, path = pafs.FileSystem.from_uri(folder)
    own = re.compile(rf"{re.escape(key)}_[A-Za-z0-9-]+_\d{{5}}_\.png")
    found = [f.path for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.is_file and own.fullmatch(f.base_name)]
    for file in found:
        fs.delete_file(file)
    return len(found)


def setting(name: str, default, check: Callable[[str], object], environ: Mapping[str, str] = os.environ):
    """A setting of the environment, checked, or its default where it is unset or empty; a wrong one names itself."""
    text = environ.get(name)
    if not text:
        return default
    try:
        return check(text)
    except ValueError as e:
        raise ValueError(f"{name}={text!r}: {e}") from e


def share(text: str) -> float:
    """A number from 0 to 1."""
    try:
        value = float(text)
    except ValueError:
        value = -1.0
    if not 0 <= value <= 1:
        raise ValueError("not a number from 0 to 1")
    return value


def one_of(*names: str) -> Callable[[str], str]:
    """A check that a name is one of these."""

    def check(text: str) -> str:
        if text not in names:
            raise ValueError(f"choose one of {', '.join(sorted(names))}")
        return text

    return check


def run_decoder(command: list[str], mode: str, path: str) -> bytes:
    """The record stream that a decoder writes for a file; a failing one raises with what it said."""
    done = subprocess.run([*command, mode, path], capture_output=True, check=False)
    if done.returncode:
        raise RuntimeError(f"the decoder ended with {done.returncode}: {done.stderr.decode(errors='replace').strip()}")
    return done.stdout


def disk_free(path: str) -> int:
    """Free bytes where path is, or would be."""
    while not os.path.exists(path) and os.path.dirname(path) != path:
        path = os.path.dirname(path)
    return shutil.disk_usage(path).free

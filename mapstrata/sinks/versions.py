"""Several outputs that change together.

Every run writes its outputs in a folder of its own, named by a version. When all are there, one small file is replaced that names
the version that counts, so readers find the outputs of one run, whatever becomes of the next. A path ``folder#name`` means
the output of that name in the version that counts when it is read.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs

from mapstrata.session import located

CURRENT = "current.json"


def new_version(folder: str) -> str:
    """Folder of a version that no reader knows yet."""
    return f"{folder.rstrip('/')}/v-{uuid.uuid4().hex}"


def publish(folder: str, version: str, names: list[str]) -> None:
    """Make ``version``, a folder that ``new_version`` gave, the one that counts. ``names``: its outputs."""
    files, path = located(folder.rstrip("/"))
    draft = f"{path}/.{uuid.uuid4().hex}.draft"
    with files.open_output_stream(draft) as out:
        out.write(json.dumps({"version": version.rsplit("/", 1)[1], "names": sorted(names)}).encode())
    files.move(draft, f"{path}/{CURRENT}")


def _current(folder: str) -> dict | None:
    files, path = located(folder.rstrip("/"))
    if files.get_file_info(f"{path}/{CURRENT}").type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(f"{path}/{CURRENT}") as file:
        return json.loads(file.read())


def resolved(path: str) -> str:
    """The path of an output; ``folder#name`` by the version that counts, any other path as it is."""
    folder, mark, name = path.rpartition("#")
    if not mark:
        return path
    found = _current(folder)
    if found is None or name not in found["names"]:
        raise FileNotFoundError(f"{folder} has no published output {name}")
    return f"{folder.rstrip('/')}/{found['version']}/{name}"


def remove_old_versions(folder: str) -> list[str]:
    """Delete all versions but the one that counts, and those not published; to be run when no reader uses them. Their names."""
    found = _current(folder)
    files, path = located(folder.rstrip("/"))
    kept = found["version"] if found else None
    old = [i for i in files.get_file_info(fs.FileSelector(path)) if i.type == fs.FileType.Directory and i.base_name.startswith("v-") and i.base_name != kept]
    for info in old:
        files.delete_dir(info.path)
    return sorted(i.base_name for i in old)

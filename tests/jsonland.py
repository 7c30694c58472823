"""Write landed API JSON pages into a landing folder for tests."""

from __future__ import annotations

import json
import os
from urllib.parse import quote


def _repo_dir(repo: str) -> str:
    return f"repo={quote(repo, safe='')}"


def write_page(landing: str, entity: str, objs, repo: str | None = None, pr: int | None = None,
               page: int = 1, raw_text: str | None = None) -> str:
    parts = [landing, entity]
    if repo is not None:
        parts.append(_repo_dir(repo))
    if pr is not None:
        parts.append(f"pr_number={pr}")
    d = os.path.join(*parts)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, f"page-{page}.json")
    with open(p, "w") as f:
        f.write(raw_text if raw_text is not None else json.dumps(objs))
    return p


def commit(sha, name="Ann", email="ann@x.org", date="2024-05-16T10:00:00Z", message="fix", login="ann",
           stats=(150, 30, 180)):
    o = {"sha": sha, "commit": {"message": message, "author": {"name": name, "email": email, "date": date}},
         "author": {"login": login, "id": 1}}
    if stats is not None:
        o["stats"] = {"additions": stats[0], "deletions": stats[1], "total": stats[2]}
    return o


def pull(number, state="open", created="2024-05-01T00:00:00Z", updated="2024-05-16T00:00:00Z", merged=None,
         login="bob", title=None):
    return {"number": number, "title": title or f"PR {number}", "state": state, "created_at": created,
            "updated_at": updated, "merged_at": merged, "merge_commit_sha": "abc" if merged else None,
            "user": {"login": login, "id": 2}}


def review(rid, state="APPROVED", submitted="2024-05-17T00:00:00Z", body=None, login="cat"):
    o = {"id": rid, "state": state, "submitted_at": submitted, "user": {"login": login, "id": 3}}
    if body is not None:
        o["body"] = body
    return o


def repository(rid, full_name, language="Java", extra=False):
    o = {"id": rid, "name": full_name.split("/")[-1], "full_name": full_name, "owner": {"login": full_name.split("/")[0]},
         "language": language, "created_at": "2021-01-01T00:00:00Z", "updated_at": "2024-05-01T00:00:00Z",
         "visibility": "public", "fork": False, "stargazers_count": 7}
    if extra:
        o["extra_field"] = {"anything": [1, 2, 3]}
    return o

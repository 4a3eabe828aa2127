"""Commands in stages: a plan, a log for each, and a verdict; the first that fails ends the run."""

from __future__ import annotations

import json
import os
import subprocess
import time

from ..sources.files import write_atomic


def run_stages(commands: list[list[str]], output: str, dry_run: bool = False, cwd: str | None = None) -> dict:
    """Run the commands one after another into a new folder and return the verdict, or just the plan.

    ``plan.json`` is written before the first command, ``stage_N.log`` has what each says, and
    ``validation.json`` comes last: whether all ended well, their exit codes, the log of the one that did not.
    """
    plan = {"commands": commands, "stages": len(commands)}
    if dry_run:
        return plan
    os.makedirs(output)  # an output that exists is kept
    write_atomic(f"{output}/plan.json", json.dumps(plan, indent=1) + "\n")
    began, stages, failed = time.monotonic(), [], None
    for n, command in enumerate(commands, 1):
        with open(f"{output}/stage_{n}.log", "w", encoding="utf-8") as log:
            code = subprocess.run(command, cwd=cwd, stdout=log, stderr=subprocess.STDOUT, check=False).returncode
        stages.append({"stage": n, "exit_code": code})
        if code:
            failed = f"stage_{n}.log"
            break
    verdict = {"passed": failed is None, "stages": stages, "failed_log": failed, "elapsed_seconds": round(time.monotonic() - began, 2)}
    write_atomic(f"{output}/validation.json", json.dumps(verdict, indent=1) + "\n")
    return verdict

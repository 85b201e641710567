"""A broker for tests: lots of messages as lines of files, with failures where they are planned."""

import json
import os
import uuid


class Broker:
    def __init__(self, options):
        self.path, self.fails = options["path"], int(options.get("fails", 0))
        os.makedirs(self.path, exist_ok=True)

    def send(self, lot):
        marks = [f for f in os.listdir(self.path) if f.startswith("fail")]
        if len(marks) < self.fails:
            open(f"{self.path}/fail-{uuid.uuid4().hex}", "w").close()
            if len(marks) % 2:  # taken, but the answer is lost
                self._write(lot)
            raise ConnectionError("planned")
        self._write(lot)

    def _write(self, lot):
        with open(f"{self.path}/lot-{uuid.uuid4().hex}", "w") as f:
            f.writelines(json.dumps(m.decode()) + "\n" for m in lot)

    def close(self):
        pass


def broker(options):
    return Broker(options)


def taken(path):
    return [json.loads(line) for name in os.listdir(path) if name.startswith("lot") for line in open(f"{path}/{name}")]

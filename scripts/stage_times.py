"""Summarise a Spark event log (written by bench.py with BENCH_EVENT_LOG_DIR):
per job wall time and the slowest stages. Usage: stage_times.py <log dir>"""
import json
import os
import sys


def events(path):
    files = []
    for root, _, names in os.walk(path):
        files += [os.path.join(root, n) for n in sorted(names) if not n.startswith(".")]
    for f in files:
        with open(f) as fh:
            for line in fh:
                if line.strip():
                    yield json.loads(line)


def main():
    jobs, stages = {}, []
    for e in events(sys.argv[1]):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            s = e["Stage Info"]
            stages.append((s.get("Completion Time", 0) - s.get("Submission Time", 0),
                           s["Stage ID"], s["Number of Tasks"], s["Stage Name"][:60],
                           s.get("Submission Time", 0)))
    total = sum(end - start for start, end in jobs.values() if end)
    print(f"{len(jobs)} jobs, {total} ms in jobs, {len(stages)} stages")
    if "--all" in sys.argv:
        t0 = min(st[4] for st in stages)
        for ms, sid, tasks, name, sub in sorted(stages, key=lambda st: st[1]):
            print(f"stage {sid:5d} +{(sub - t0) / 1000:7.2f}s {ms:7d} ms {tasks:5d} tasks  {name}")
        return
    for ms, sid, tasks, name, _ in sorted(stages, reverse=True)[:15]:
        print(f"stage {sid:5d} {ms:7d} ms {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()

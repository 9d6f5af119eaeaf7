"""What the Parquet scans of an executed plan read."""


def scan_metrics(df) -> dict[str, int]:
    """numFiles, numOutputRows, ... summed over the scans of ``df``, after running it."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    out: dict[str, int] = {}

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "TableCacheQueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            it = metrics.keysIterator()
            while it.hasNext():
                k = it.next()
                out[k] = out.get(k, 0) + metrics.apply(k).value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(query.executedPlan())
    return out

"""The inner loops of tree growing as Java that Spark's own compiler makes and its executors run.

The driver compiles SOURCE once a session with Janino, which Spark uses for its generated code, and adds it
to the session as a jar.  A table is broadcast once as plain arrays that all tasks of an executor share, and
a task grows whole trees over it.  The trees are those of the numpy code in ``trees``, which grows them where
the table is too large: draws are the same hashes, counts and gradients are whole numbers.

Codes lie row by row.  A forest's tree sorts the numbers of its rows into its nodes in place; rows that are
not drawn for the tree, or held, come along and get its value in the end.  The rows of a node that has become
small are copied together first.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SOURCE = r"""
package loanlens.kernel;

import java.io.Serializable;
import java.util.ArrayDeque;
import java.util.ArrayList;
import java.util.Iterator;
import org.apache.spark.api.java.function.MapPartitionsFunction;
import org.apache.spark.broadcast.Broadcast;
import org.apache.spark.sql.Row;
import org.apache.spark.sql.RowFactory;

public class Task implements MapPartitionsFunction, Serializable {
  /* rows of a node that are copied together; rows whose sums fit the fields of one number */
  static final int NEAR = 16384, BLOCK = 65536;
  /* nodes below this many rows keep the codes they have seen in a bitmap */
  static final int FEW = 192;
  static final long TREE = 1, ROW = 2, FEATURE = 3, CUT = 4, LEFT = 5, RIGHT = 6;
  static final double UNITS = 16777216.0, LEAST_HESSIAN = 1e-3, HELD_OUT = 0.1, TOLERANCE = 1e-7;
  static final int PATIENCE = 10;

  Broadcast table;
  /* of trees, some after others */
  Broadcast[] slices;
  String mode;
  String[] work;

  public Task() {}

  /* mode: trees or sums, with a line of work for each id; or scores, with the whole parts of a probability */
  public Task with(Broadcast table, String mode, String work) {
    this.table = table;
    this.mode = mode;
    this.work = work.split("\n");
    return this;
  }

  public Task over(Broadcast[] slices, int total) {
    this.slices = slices;
    this.mode = "values";
    this.work = new String[] {Integer.toString(total)};
    return this;
  }

  /* Packed trees by their number as arrays. */
  public Object[] unpack(Iterator trees) {
    java.util.TreeMap found = new java.util.TreeMap();
    while (trees.hasNext()) {
      Row tree = (Row) trees.next();
      java.nio.ByteBuffer in = java.nio.ByteBuffer.wrap((byte[]) tree.get(1)).order(java.nio.ByteOrder.LITTLE_ENDIAN);
      int n = (int) in.getLong();
      double[] value = new double[n];
      int[] left = new int[n];
      short[] feature = new short[n];
      byte[] cut = new byte[n];
      for (int i = 0; i < n; i++) value[i] = in.getDouble();
      for (int i = 0; i < n; i++) left[i] = in.getInt();
      for (int i = 0; i < n; i++) feature[i] = in.getShort();
      in.get(cut);
      found.put(Long.valueOf(tree.getLong(0)), new Object[] {feature, cut, left, value});
    }
    return found.values().toArray();
  }

  /* Arrays of a table from its blocks (hashes, labels, flags, codes), which come in the order of the hashes. */
  public Object[] load(Iterator blocks, int n, int total, double[] low, double[] high) {
    byte[] cells = new byte[n * total], labels = new byte[n], held = new byte[n];
    long[] hash = new long[n];
    int at = 0;
    while (blocks.hasNext()) {
      Row block = (Row) blocks.next();
      byte[] own = (byte[]) block.get(1), codes = (byte[]) block.get(3);
      int m = own.length;
      java.nio.ByteBuffer.wrap((byte[]) block.get(0)).order(java.nio.ByteOrder.LITTLE_ENDIAN).asLongBuffer().get(hash, at, m);
      System.arraycopy(own, 0, labels, at, m);
      System.arraycopy((byte[]) block.get(2), 0, held, at, m);
      System.arraycopy(codes, 0, cells, at * total, m * total);
      at += m;
    }
    if (at != n) throw new IllegalStateException(at + " rows, not " + n);
    return new Object[] {cells, hash, labels, held, low, high};
  }

  public Iterator call(Iterator rows) {
    if (mode.equals("values")) return new Values(slices, Integer.parseInt(work[0]), rows);
    Object[] own = (Object[]) table.value();
    if (mode.equals("scores")) return new Scores(own, Double.parseDouble(work[0]), rows);
    return new Grown(own, work, mode.equals("trees"), rows);
  }

  static long mix(long x) {
    x = (x ^ (x >>> 30)) * 0xBF58476D1CE4E5B9L;
    x = (x ^ (x >>> 27)) * 0x94D049BB133111EBL;
    return x ^ (x >>> 31);
  }

  static long salted(long x, long salt, long number) {
    return mix(x + number * 0x9E3779B97F4A7C15L + (salt << 56));
  }

  static double uniform(long x) {
    return (double) (x >>> 11) / 9007199254740992.0;
  }

  /* as log2 of trees.py, step by step */
  static double log2(double x) {
    int e = Math.getExponent(x);
    if (e < -1022) return log2(x * 18014398509481984.0) - 54;
    double m = Double.longBitsToDouble((Double.doubleToRawLongBits(x) & 0x000FFFFFFFFFFFFFL) | 0x3FE0000000000000L);
    e += 1;
    if (m < 0.7071067811865476) {
      m *= 2.0;
      e -= 1;
    }
    double s = (m - 1.0) / (m + 1.0), z = s * s, p = 1.0 / 23.0;
    for (int k = 21; k > 0; k -= 2) p = p * z + 1.0 / k;
    return e + 2.8853900817779268 * s * p;
  }

  static double term(double part, double total) {
    return part * log2(part > 0 ? part / Math.max(total, 1e-300) : 1.0);
  }

  /* Rows whose code is at most cut come first, others after them; gives the place where these begin. */
  static int part(byte[] codes, int total, int f, int cut, int[] items, int start, int end, int[] moved) {
    int l = start, r = 0;
    for (int i = start; i < end; i++) {
      /* without a branch, which would be guessed wrong for many rows */
      int row = items[i], goes = (codes[row * total + f] & 255) - cut - 1 >>> 31;
      items[l] = row;
      moved[r] = row;
      l += goes;
      r += 1 - goes;
    }
    System.arraycopy(moved, 0, items, l, r);
    return l;
  }

  /* Features in the order of their hashes. */
  static void order(int total, long key, int[] out, long[] hash) {
    for (int f = 0; f < total; f++) {
      long h = salted(key, FEATURE, f);
      int i = f;
      for (; i > 0 && Long.compareUnsigned(hash[i - 1], h) > 0; i--) {
        hash[i] = hash[i - 1];
        out[i] = out[i - 1];
      }
      hash[i] = h;
      out[i] = f;
    }
  }

  /* Nodes as they come, children side by side. */
  static class Nodes {
    int size = 0;
    short[] feature = new short[64];
    byte[] cut = new byte[64];
    int[] left = new int[64];
    double[] value = new double[64];

    int add(int many) {
      int first = size;
      if (size + many > feature.length) {
        int room = 2 * feature.length + many;
        feature = java.util.Arrays.copyOf(feature, room);
        cut = java.util.Arrays.copyOf(cut, room);
        left = java.util.Arrays.copyOf(left, room);
        value = java.util.Arrays.copyOf(value, room);
      }
      for (int i = first; i < first + many; i++) {
        feature[i] = -1;
        cut[i] = 0;
        left[i] = -1;
        value[i] = 0;
      }
      size += many;
      return first;
    }

    /* as Tree.pack of trees.py, nodes level by level */
    byte[] pack() {
      int[] order = new int[size];
      int many = 1;
      for (int i = 0; i < many; i++)
        if (left[order[i]] >= 0) {
          order[many++] = left[order[i]];
          order[many++] = left[order[i]] + 1;
        }
      java.nio.ByteBuffer out = java.nio.ByteBuffer.allocate(8 + 15 * many).order(java.nio.ByteOrder.LITTLE_ENDIAN);
      out.putLong(many);
      for (int i = 0; i < many; i++) out.putDouble(value[order[i]]);
      int next = 1;
      for (int i = 0; i < many; i++) {
        out.putInt(left[order[i]] >= 0 ? next : -1);
        if (left[order[i]] >= 0) next += 2;
      }
      for (int i = 0; i < many; i++) out.putShort(feature[order[i]]);
      for (int i = 0; i < many; i++) out.put(cut[order[i]]);
      return out.array();
    }
  }

  /* Grows the trees of one forest, one after another. */
  static class Forest {
    final byte[] cells, labels, held;
    final long[] hash;
    final double[] low, high;
    final int n, total, k, maxDepth;
    final long least, leastLeaf, seed;
    final boolean entropy, randomCuts, bootstrap, perTree, balanced;
    final double[][] steps;
    final double parts;
    final long[] whole;
    /* of the tree in the making */
    final byte[] drawn;
    final int[] items, moved;
    long[] totals;
    Nodes nodes;
    double zeroWeight, oneWeight;
    /* (feature, code): rows << 42 | weights << 21 | ones; and in three tables for nodes beyond BLOCK rows */
    final long[] hist, large;
    final byte[] nearCells, nearDrawn;
    final int[] nearNames, nearItems, nearMoved;
    final long[] pack = new long[64];
    /* the best cut so far */
    double bestScore;
    int bestFeature, bestCut;
    long bestWeight, bestOnes;
    boolean varies;
    final int[] code = new int[256], ordered, wanted;
    final long[] rows = new long[256], hashes;
    final double[] weights = new double[256], ones = new double[256], score = new double[256];

    Forest(Object[] table, String[] s) {
      cells = (byte[]) table[0];
      hash = (long[]) table[1];
      labels = (byte[]) table[2];
      held = (byte[]) table[3];
      low = (double[]) table[4];
      high = (double[]) table[5];
      n = hash.length;
      total = low.length / 256;
      entropy = !s[4].equals("gini");
      maxDepth = Integer.parseInt(s[5]);
      leastLeaf = Math.max(Long.parseLong(s[7]), 1);
      least = Math.max(Math.max(Long.parseLong(s[6]), 2 * Long.parseLong(s[7])), 2);
      k = Integer.parseInt(s[8]);
      bootstrap = s[9].equals("1");
      balanced = !s[10].equals("none");
      perTree = s[10].equals("balanced_subsample");
      randomCuts = s[11].equals("1");
      seed = Long.parseLong(s[12]);
      parts = Double.parseDouble(s[13]);
      whole = new long[] {Long.parseLong(s[14]), Long.parseLong(s[15])};
      steps = new double[2][31];
      for (int i = 0; i < 31; i++) {
        steps[0][i] = Double.parseDouble(s[16 + i]);
        steps[1][i] = Double.parseDouble(s[47 + i]);
      }
      drawn = new byte[n];
      items = new int[n];
      moved = new int[n];
      hist = new long[total * 256];
      large = new long[3 * total * 256];
      nearCells = new byte[NEAR * total];
      nearDrawn = new byte[NEAR];
      nearNames = new int[NEAR];
      nearItems = new int[NEAR];
      nearMoved = new int[NEAR];
      ordered = new int[total];
      wanted = new int[total];
      hashes = new long[total];
      for (int x = 0; x < 64; x++) pack[x] = 1L << 42 | (long) (x >> 1) << 21 | ((x & 1) == 1 ? x >> 1 : 0);
    }

    Nodes grow(int number, long[] into) {
      long key = salted(salted(seed, TREE, 0), TREE, number);
      totals = into;
      nodes = new Nodes();
      nodes.add(1);
      int d = 0, r = 0;
      long[] counts = new long[2];
      for (int i = 0; i < n; i++) {
        int w = 1;
        if (held[i] != 0) w = 0;
        else if (bootstrap) {
          double u = uniform(salted(hash[i] ^ key, ROW, 0));
          double[] s = steps[labels[i] == 1 ? 1 : 0];
          for (w = 0; w < 31 && s[w] <= u; w++);
        }
        drawn[i] = (byte) (w << 1 | labels[i]);
        if (w > 0) items[d++] = i;
        else moved[r++] = i;
        counts[labels[i]] += w;
      }
      System.arraycopy(moved, 0, items, d, r);
      zeroWeight = oneWeight = 1.0;
      if (balanced) {
        long[] from = perTree ? counts : whole;
        zeroWeight = (from[0] + from[1]) / (2.0 * Math.max(from[0], 1));
        oneWeight = (from[0] + from[1]) / (2.0 * Math.max(from[1], 1));
      }
      grow(cells, drawn, items, moved, null, 0, 0, d, n, 0, counts[0] + counts[1], counts[1], key);
      return nodes;
    }

    void grow(byte[] cells, byte[] drawn, int[] items, int[] moved, int[] names, int node0, int start0, int mid0, int end0, int depth0, long weight0, long ones0, long key0) {
      int[] places = new int[5 * 64];
      long[] sums = new long[3 * 64];
      int size = 1;
      places[0] = node0;
      places[1] = start0;
      places[2] = mid0;
      places[3] = end0;
      places[4] = depth0;
      sums[0] = weight0;
      sums[1] = ones0;
      sums[2] = key0;
      while (size > 0) {
        size--;
        int node = places[5 * size], start = places[5 * size + 1], mid = places[5 * size + 2], end = places[5 * size + 3], depth = places[5 * size + 4];
        long weight = sums[3 * size], one = sums[3 * size + 1], key = sums[3 * size + 2];
        int m = end - start;
        if (names == null && m <= NEAR) {
          for (int i = 0; i < m; i++) {
            int row = items[start + i];
            System.arraycopy(cells, row * total, nearCells, i * total, total);
            nearDrawn[i] = drawn[row];
            nearNames[i] = row;
            nearItems[i] = i;
          }
          grow(nearCells, nearDrawn, nearItems, nearMoved, nearNames, node, 0, mid - start, m, depth, weight, one, key);
          continue;
        }
        long zero = weight - one;
        double a = one * oneWeight, value = mid > start ? a / Math.max(a + zero * zeroWeight, 1e-300) : 0.0;
        nodes.value[node] = value;
        bestScore = Double.NEGATIVE_INFINITY;
        bestFeature = -1;
        varies = false;
        if (mid - start >= least && zero > 0 && one > 0 && (maxDepth < 0 || depth < maxDepth)) {
          int many = Math.min(k, total);
          if (many < total) {
            order(total, key, ordered, hashes);
            System.arraycopy(ordered, 0, wanted, 0, many);
            java.util.Arrays.sort(wanted, 0, many);
          } else for (int f = 0; f < total; f++) wanted[f] = f;
          look(cells, drawn, items, start, mid, weight, one, key, many);
          for (int i = many; i < total && !varies; i++) {
            wanted[0] = ordered[i];
            look(cells, drawn, items, start, mid, weight, one, key, 1);
          }
        }
        if (bestFeature < 0) {
          if (totals != null) {
            long add = (long) Math.rint(value * parts);
            for (int i = start; i < end; i++) totals[names == null ? items[i] : names[items[i]]] += add;
          }
          continue;
        }
        int l = part(cells, total, bestFeature, bestCut, items, start, mid, moved);
        int other = part(cells, total, bestFeature, bestCut, items, mid, end, moved);
        /* left drawn, right drawn, left others, right others: the two in the middle change places */
        int ours = mid - l, theirs = other - mid;
        if (ours > 0 && theirs > 0) {
          System.arraycopy(items, mid, moved, 0, theirs);
          System.arraycopy(items, l, items, l + theirs, ours);
          System.arraycopy(moved, 0, items, l, theirs);
        }
        int left = nodes.add(2);
        nodes.feature[node] = (short) bestFeature;
        nodes.cut[node] = (byte) bestCut;
        nodes.left[node] = left;
        if (5 * (size + 2) > places.length) {
          places = java.util.Arrays.copyOf(places, 2 * places.length);
          sums = java.util.Arrays.copyOf(sums, 2 * sums.length);
        }
        int p = 5 * size, q = 3 * size;
        places[p] = left + 1;
        places[p + 1] = l + theirs;
        places[p + 2] = l + theirs + ours;
        places[p + 3] = end;
        places[p + 4] = depth + 1;
        sums[q] = weight - bestWeight;
        sums[q + 1] = one - bestOnes;
        sums[q + 2] = salted(key, RIGHT, 0);
        places[p + 5] = left;
        places[p + 6] = start;
        places[p + 7] = l;
        places[p + 8] = l + theirs;
        places[p + 9] = depth + 1;
        sums[q + 3] = bestWeight;
        sums[q + 4] = bestOnes;
        sums[q + 5] = salted(key, LEFT, 0);
        size += 2;
      }
    }

    static void addFew(byte[] cells, int total, int f, byte[] drawn, int[] items, int start, int mid, long[] pack, long[] hist, long[] seen) {
      seen[0] = seen[1] = seen[2] = seen[3] = 0;
      for (int i = start; i < mid; i++) {
        int row = items[i], x = cells[row * total + f] & 255;
        seen[x >> 6] |= 1L << x;
        hist[x] += pack[drawn[row]];
      }
    }

    static void addMany(byte[] cells, int total, int[] wanted, int many, byte[] drawn, int[] items, int from, int to, long[] pack, long[] hist) {
      for (int i = from; i < to; i++) {
        int row = items[i], at = row * total, base = 0;
        long v = pack[drawn[row]];
        for (int j = 0; j < many; j++) {
          hist[base + (cells[at + wanted[j]] & 255)] += v;
          base += 256;
        }
      }
    }

    final long[] seen = new long[4];

    void look(byte[] cells, byte[] drawn, int[] items, int start, int mid, long weight, long one, long key, int many) {
      final long field = (1L << 21) - 1;
      int size = mid - start;
      if (size < FEW) {
        for (int j = 0; j < many; j++) {
          int f = wanted[j], m = 0;
          long a = 0, b = 0, c = 0;
          addFew(cells, total, f, drawn, items, start, mid, pack, hist, seen);
          for (int q = 0; q < 4; q++)
            for (long bits = seen[q]; bits != 0; bits &= bits - 1) {
              int x = q * 64 + Long.numberOfTrailingZeros(bits);
              long v = hist[x];
              hist[x] = 0;
              a += v >>> 42;
              b += (v >>> 21) & field;
              c += v & field;
              code[m] = x;
              rows[m] = a;
              weights[m] = b;
              ones[m++] = c;
            }
          offer(f, m, size, weight, one, key);
        }
        return;
      }
      int count = many * 256;
      boolean wide = size > BLOCK;
      if (wide) java.util.Arrays.fill(large, 0, 3 * count, 0L);
      for (int from = start; from < mid; from += BLOCK) {
        addMany(cells, total, wanted, many, drawn, items, from, Math.min(mid, from + BLOCK), pack, hist);
        if (wide) {
          for (int i = 0; i < count; i++) {
            long v = hist[i];
            large[i] += v >>> 42;
            large[count + i] += (v >>> 21) & field;
            large[2 * count + i] += v & field;
          }
          java.util.Arrays.fill(hist, 0, count, 0L);
        }
      }
      for (int j = 0; j < many; j++) {
        int m = 0;
        long a = 0, b = 0, c = 0;
        for (int x = 0; x < 256; x++) {
          int i = j * 256 + x;
          if (wide) {
            if (large[i] == 0) continue;
            a += large[i];
            b += large[count + i];
            c += large[2 * count + i];
          } else {
            long v = hist[i];
            if (v == 0) continue;
            a += v >>> 42;
            b += (v >>> 21) & field;
            c += v & field;
          }
          code[m] = x;
          rows[m] = a;
          weights[m] = b;
          ones[m++] = c;
        }
        offer(wanted[j], m, size, weight, one, key);
      }
      java.util.Arrays.fill(hist, 0, count, 0L);
    }

    static void ginis(int from, int to, double zero, double one, double a0, double a1, double[] weights, double[] ones, double[] score) {
      for (int i = from; i < to; i++) {
        double w = weights[i], o = ones[i];
        double l1 = o * a1, l0 = (w - o) * a0, r1 = (one - o) * a1, r0 = (zero - (w - o)) * a0;
        score[i] = (l0 * l0 + l1 * l1) / (l0 + l1) + (r0 * r0 + r1 * r1) / (r0 + r1);
      }
    }

    static void entropies(int from, int to, double zero, double one, double a0, double a1, double[] weights, double[] ones, double[] score) {
      for (int i = from; i < to; i++) {
        double w = weights[i], o = ones[i];
        double l1 = o * a1, l0 = (w - o) * a0, r1 = (one - o) * a1, r0 = (zero - (w - o)) * a0;
        double left = l0 + l1, right = r0 + r1;
        score[i] = ((term(l0, left) + term(l1, left)) + term(r0, right)) + term(r1, right);
      }
    }

    /* Takes the best cut of a feature from the cells of its codes, with running sums. */
    void offer(int f, int m, int size, long weight, long one, long key) {
      if (m == 0) return;
      if (m > 1) varies = true;
      int from = 0, to = m;
      if (randomCuts) {
        double first = low[f * 256 + code[0]], last = high[f * 256 + code[m - 1]];
        double at = first + uniform(salted(key, CUT, f)) * (last - first);
        int below = 0;
        for (int i = 0; i < m; i++) if (high[f * 256 + code[i]] <= at) below++;
        below = Math.min(Math.max(below, 1), Math.max(m - 1, 1));
        from = below - 1;
        to = below;
      }
      while (from < to && rows[from] < leastLeaf) from++;
      while (from < to && size - rows[to - 1] < leastLeaf) to--;
      if (from >= to) return;
      if (entropy) entropies(from, to, weight - one, one, zeroWeight, oneWeight, weights, ones, score);
      else ginis(from, to, weight - one, one, zeroWeight, oneWeight, weights, ones, score);
      double most = bestScore;
      int at = -1;
      for (int i = from; i < to; i++)
        if (score[i] > most) {
          most = score[i];
          at = i;
        }
      if (at >= 0) {
        bestScore = most;
        bestFeature = f;
        bestCut = code[at];
        bestWeight = (long) weights[at];
        bestOnes = (long) ones[at];
      }
    }
  }

  /* Grows boosted trees over all rows that are not held; all rows are scored. */
  static class Boosting {
    final byte[] cells, labels, held;
    final long[] hash;
    final int n, total, k, rounds, maxDepth, maxLeaves;
    final long leastSplit, leastLeaf, seed;
    final boolean newton, stops;
    final double rate, share, l2, start;
    final double[] score;
    final byte[] use;
    final int[] g, h, rows, moved, ordered;
    final long[] hashes;
    final int cellsOf;
    ArrayList grown = new ArrayList();

    Boosting(Object[] table, String[] s) {
      cells = (byte[]) table[0];
      hash = (long[]) table[1];
      labels = (byte[]) table[2];
      held = (byte[]) table[3];
      n = hash.length;
      total = ((double[]) table[4]).length / 256;
      rounds = Integer.parseInt(s[4]);
      rate = Double.parseDouble(s[5]);
      maxDepth = Integer.parseInt(s[6]);
      maxLeaves = Integer.parseInt(s[7]);
      leastSplit = Long.parseLong(s[8]);
      leastLeaf = Long.parseLong(s[9]);
      k = Integer.parseInt(s[10]);
      share = Double.parseDouble(s[11]);
      l2 = Double.parseDouble(s[12]);
      newton = s[13].equals("1");
      stops = s[14].equals("1");
      seed = Long.parseLong(s[15]);
      start = Double.parseDouble(s[16]);
      score = new double[n];
      java.util.Arrays.fill(score, start);
      use = new byte[n];
      g = new int[n];
      h = new int[n];
      rows = new int[n];
      moved = new int[n];
      ordered = new int[total];
      hashes = new long[total];
      cellsOf = total * 256;
      long out = salted(seed, CUT, 0);
      /* 1: grown on, 2: there to tell when to stop */
      for (int i = 0; i < n; i++)
        if (held[i] == 0) use[i] = (byte) (stops && uniform(salted(hash[i] ^ out, ROW, 0)) < HELD_OUT ? 2 : 1);
    }

    static void gradients(double[] score, byte[] labels, int[] g, int[] h) {
      for (int i = 0; i < score.length; i++) {
        double p = 1.0 / (1.0 + Math.exp(-score[i]));
        g[i] = (int) Math.rint((p - labels[i]) * UNITS);
        h[i] = (int) Math.rint(p * (1 - p) * UNITS);
      }
    }

    double loss() {
      double sum = 0;
      long many = 0;
      for (int i = 0; i < n; i++)
        if (use[i] == 2) {
          double x = score[i];
          sum += Math.max(x, 0.0) + Math.log1p(Math.exp(-Math.abs(x))) - labels[i] * x;
          many++;
        }
      return many == 0 ? Double.NaN : sum / many;
    }

    static void addRows(byte[] cells, int total, int[] rows, int from, int to, int[] g, int[] h, boolean newton, long[] both) {
      for (int i = from; i < to; i++) {
        int row = rows[i], at = row * total;
        long v = (1L << 42) + g[row], w = h[row];
        if (newton) {
          for (int f = 0; f < total; f++) {
            int x = 2 * ((f << 8) + (cells[at + f] & 255));
            both[x] += v;
            both[x + 1] += w;
          }
        } else {
          both[2 * (cells[at] & 255) + 1] += w;
          for (int f = 0; f < total; f++) both[2 * ((f << 8) + (cells[at + f] & 255))] += v;
        }
      }
    }

    /* (rows, gradients, hessians) by feature and code; without newton hessians of the first feature alone. */
    long[] sums(int from, int to) {
      long[] out = new long[3 * cellsOf], both = new long[2 * cellsOf];
      for (int a = from; a < to; a += BLOCK) {
        addRows(cells, total, rows, a, Math.min(to, a + BLOCK), g, h, newton, both);
        for (int i = 0; i < cellsOf; i++) {
          long v = both[2 * i], s = v << 22 >> 22;
          out[i] += v - s >> 42;
          out[cellsOf + i] += s;
          out[2 * cellsOf + i] += both[2 * i + 1];
          both[2 * i] = both[2 * i + 1] = 0;
        }
      }
      return out;
    }

    static class Leaf {
      int from, to, depth, feature = -1, cut, number;
      long key;
      long[] hist;
      double gain;
      /* children, known or not; and whether they are in the tree */
      Leaf left, right;
      boolean split = false;
    }

    void best(Leaf x) {
      long[] hist = x.hist;
      x.feature = -1;
      long all = 0, sumG0 = 0, sumH0 = 0;
      for (int c = 0; c < 256; c++) {
        all += hist[c];
        sumG0 += hist[cellsOf + c];
        sumH0 += hist[2 * cellsOf + c];
      }
      if (all < Math.max(leastSplit, 2 * leastLeaf)) return;
      double sumG = sumG0 / UNITS, sumH = sumH0 / UNITS, most = Double.NEGATIVE_INFINITY;
      long least = Math.max(leastLeaf, 1);
      boolean[] may = new boolean[total];
      if (k < total) {
        order(total, x.key, ordered, hashes);
        boolean varies = false;
        for (int i = 0; i < total && (i < k || !varies); i++) {
          may[ordered[i]] = true;
          int seen = 0;
          for (int c = 0; c < 256 && seen < 2; c++) if (hist[ordered[i] * 256 + c] > 0) seen++;
          varies |= seen > 1;
        }
      } else java.util.Arrays.fill(may, true);
      for (int f = 0; f < total; f++) {
        if (!may[f]) continue;
        long m = 0, g0 = 0, h0 = 0;
        for (int c = 0; c < 256; c++) {
          int i = f * 256 + c;
          if (hist[i] == 0) continue;
          m += hist[i];
          g0 += hist[cellsOf + i];
          h0 += hist[2 * cellsOf + i];
          if (m < least || all - m < least) continue;
          double a = g0 / UNITS, gain;
          if (newton) {
            double b = h0 / UNITS;
            if (b < LEAST_HESSIAN || sumH - b < LEAST_HESSIAN) continue;
            gain = a * a / (b + l2) + (sumG - a) * (sumG - a) / (sumH - b + l2) - sumG * sumG / (sumH + l2);
            if (!(gain > 0)) continue;
          } else {
            double apart = a / m - (sumG - a) / (all - m);
            gain = (double) m * (all - m) / all * apart * apart;
          }
          if (gain > most) {
            most = gain;
            x.feature = f;
            x.cut = c;
          }
        }
      }
      x.gain = most;
    }

    double valueOf(Leaf x) {
      long g0 = 0, h0 = 0;
      for (int c = 0; c < 256; c++) {
        g0 += x.hist[cellsOf + c];
        h0 += x.hist[2 * cellsOf + c];
      }
      double a = g0 / UNITS, b = h0 / UNITS;
      if (newton) return b + l2 > 0 ? -a / (b + l2) : 0.0;
      return b > 1e-150 ? -a / b : 0.0;
    }

    void divide(Leaf x, int number) {
      int at = part(cells, total, x.feature, x.cut, rows, x.from, x.to, moved);
      x.left = new Leaf();
      x.right = new Leaf();
      x.left.from = x.from;
      x.left.to = x.right.from = at;
      x.right.to = x.to;
      x.left.number = number;
      x.right.number = number + 1;
      x.left.depth = x.right.depth = x.depth + 1;
      x.left.key = salted(x.key, LEFT, 0);
      x.right.key = salted(x.key, RIGHT, 0);
      Leaf less = at - x.from <= x.to - at ? x.left : x.right, more = less == x.left ? x.right : x.left;
      less.hist = sums(less.from, less.to);
      long[] other = (long[]) x.hist.clone();
      for (int i = 0; i < other.length; i++) other[i] -= less.hist[i];
      more.hist = other;
      best(x.left);
      best(x.right);
    }

    boolean can(Leaf x) {
      return x.feature >= 0 && (maxDepth < 0 || x.depth < maxDepth);
    }

    /* as grow_best_first of trees.py */
    Nodes tree(long key, int m) {
      Leaf root = new Leaf();
      root.to = m;
      root.key = key;
      root.hist = sums(0, m);
      best(root);
      ArrayList leaves = new ArrayList();
      leaves.add(root);
      int known = 1;
      while (maxLeaves < 0 || leaves.size() < maxLeaves) {
        Leaf now = null;
        for (int i = 0; i < leaves.size(); i++) {
          Leaf x = (Leaf) leaves.get(i);
          if (can(x) && (now == null || x.gain > now.gain || x.gain == now.gain && x.number < now.number)) now = x;
        }
        if (now == null) break;
        if (now.left == null) {
          ArrayList asked = new ArrayList();
          for (int i = 0; i < leaves.size(); i++) {
            Leaf x = (Leaf) leaves.get(i);
            if (!can(x) || x.left != null) continue;
            int at = asked.size();
            while (at > 0 && ((Leaf) asked.get(at - 1)).gain < x.gain) at--;
            asked.add(at, x);
          }
          int many = maxLeaves < 0 ? asked.size() : Math.min(asked.size(), maxLeaves - leaves.size());
          for (int i = 0; i < many; i++) {
            divide((Leaf) asked.get(i), known);
            known += 2;
          }
        }
        now.split = true;
        now.hist = null;
        leaves.set(leaves.indexOf(now), now.left);
        leaves.add(now.right);
      }
      Nodes out = new Nodes();
      out.add(1);
      ArrayDeque open = new ArrayDeque();
      open.add(root);
      for (int i = 0; !open.isEmpty(); i++) {
        Leaf x = (Leaf) open.poll();
        if (!x.split) {
          out.value[i] = rate * valueOf(x);
          continue;
        }
        int left = out.add(2);
        out.feature[i] = (short) x.feature;
        out.cut[i] = (byte) x.cut;
        out.left[i] = left;
        open.add(x.left);
        open.add(x.right);
      }
      return out;
    }

    static void add(byte[] cells, int total, Nodes t, double[] score) {
      short[] feature = t.feature;
      byte[] cut = t.cut;
      int[] left = t.left;
      for (int i = 0; i < score.length; i++) {
        int x = 0, at = i * total;
        while (feature[x] >= 0) x = left[x] + ((cells[at + feature[x]] & 255) > (cut[x] & 255) ? 1 : 0);
        score[i] += t.value[x];
      }
    }

    static int inRound(byte[] use, long[] hash, long key, double share, int[] rows) {
      int m = 0;
      for (int i = 0; i < use.length; i++)
        if (use[i] == 1 && (share >= 1.0 || uniform(salted(hash[i] ^ key, ROW, 0)) < share)) rows[m++] = i;
      return m;
    }

    void run(boolean keep) {
      double[] losses = new double[rounds + 1];
      int many = 0;
      if (stops) {
        double first = loss();
        if (!Double.isNaN(first)) losses[many++] = first;
      }
      long base = salted(seed, TREE, 0);
      for (int r = 0; r < rounds; r++) {
        long key = salted(base, TREE, r);
        gradients(score, labels, g, h);
        Nodes t = tree(key, inRound(use, hash, key, share, rows));
        if (keep) grown.add(t.pack());
        add(cells, total, t, score);
        if (many > 0) {
          losses[many++] = loss();
          if (many > PATIENCE) {
            double least = Double.POSITIVE_INFINITY;
            for (int i = many - PATIENCE; i < many; i++) least = Math.min(least, losses[i]);
            if (least > losses[many - PATIENCE - 1] - TOLERANCE) break;
          }
        }
      }
    }
  }

  /* Parts of about BLOCK rows; equal hashes are in one part. */
  static int[] bounds(long[] hash) {
    int n = hash.length, many = 0;
    int[] out = new int[n / BLOCK + 2];
    for (int a = 0; a < n; ) {
      out[many++] = a;
      a = (int) Math.min((long) a + BLOCK, n);
      while (a < n && hash[a] == hash[a - 1]) a++;
    }
    out[many++] = n;
    return java.util.Arrays.copyOf(out, many);
  }

  static Row row(int candidate, long number, double extra, byte[] bytes) {
    return RowFactory.create(new Object[] {Integer.valueOf(candidate), Long.valueOf(number), Double.valueOf(extra), bytes});
  }

  /* Trees, or their sums over the rows in parts, made as they are asked for.  A line of work has the
     candidate, its first tree, how many, the kind, and how they are grown. */
  static class Grown implements Iterator {
    final Object[] table;
    final String[] work;
    final boolean keep;
    final Iterator ids;
    final ArrayDeque ready = new ArrayDeque();
    Forest forest;
    int candidate, next, end;

    Grown(Object[] table, String[] work, boolean keep, Iterator ids) {
      this.table = table;
      this.work = work;
      this.keep = keep;
      this.ids = ids;
    }

    public boolean hasNext() {
      while (ready.isEmpty()) {
        if (forest != null && next < end) {
          ready.add(row(candidate, next, 0.0, forest.grow(next, null).pack()));
          next++;
        } else {
          forest = null;
          if (!ids.hasNext()) return false;
          begin(work[(int) ((Row) ids.next()).getLong(0)].split(" "));
        }
      }
      return true;
    }

    public Object next() {
      if (!hasNext()) throw new java.util.NoSuchElementException();
      return ready.poll();
    }

    public void remove() {
      throw new UnsupportedOperationException();
    }

    void begin(String[] line) {
      candidate = Integer.parseInt(line[0]);
      next = Integer.parseInt(line[1]);
      end = next + Integer.parseInt(line[2]);
      if (line[3].equals("boosting")) {
        Boosting b = new Boosting(table, line);
        b.run(keep);
        if (keep) {
          for (int i = 0; i < b.grown.size(); i++) ready.add(row(candidate, i, b.start, (byte[]) b.grown.get(i)));
        } else {
          double parts = Double.parseDouble(line[17]);
          long[] sums = new long[b.n];
          for (int i = 0; i < b.n; i++) sums[i] = (long) Math.rint(parts / (1.0 + Math.exp(-b.score[i])));
          hand(sums, 1);
        }
      } else if (keep) {
        forest = new Forest(table, line);
      } else {
        Forest own = new Forest(table, line);
        long[] sums = new long[own.n];
        for (int i = next; i < end; i++) own.grow(i, sums);
        hand(sums, end - next);
      }
    }

    void hand(long[] sums, long trees) {
      int[] bounds = bounds((long[]) table[1]);
      for (int p = 0; p + 1 < bounds.length; p++) {
        java.nio.ByteBuffer out = java.nio.ByteBuffer.allocate(8 * (bounds[p + 1] - bounds[p]));
        out.asLongBuffer().put(sums, bounds[p], bounds[p + 1] - bounds[p]);
        ready.add(row(candidate, p, (double) trees, out.array()));
      }
    }
  }

  /* Rows with the sum of their trees' values in place of their codes, which come last.  BLOCK rows at a time
     pass all slices, so that not all trees are held. */
  static class Values implements Iterator {
    final Broadcast[] slices;
    final int total;
    final Iterator rows;
    Row[] held = new Row[BLOCK];
    byte[] cells = new byte[0];
    double[] sums = new double[0];
    int at = 0, size = 0;

    Values(Broadcast[] slices, int total, Iterator rows) {
      this.slices = slices;
      this.total = total;
      this.rows = rows;
    }

    static void add(byte[] cells, int total, int n, short[] feature, byte[] cut, int[] left, double[] value, double[] sums) {
      for (int i = 0; i < n; i++) {
        int x = 0, from = i * total;
        while (feature[x] >= 0) x = left[x] + ((cells[from + feature[x]] & 255) > (cut[x] & 255) ? 1 : 0);
        sums[i] += value[x];
      }
    }

    public boolean hasNext() {
      if (at < size) return true;
      at = size = 0;
      while (size < BLOCK && rows.hasNext()) held[size++] = (Row) rows.next();
      if (size == 0) return false;
      if (cells.length < size * total) cells = new byte[size * total];
      sums = new double[size];
      for (int i = 0; i < size; i++) System.arraycopy((byte[]) held[i].get(held[i].length() - 1), 0, cells, i * total, total);
      for (int s = 0; s < slices.length; s++) {
        Object[] trees = (Object[]) slices[s].value();
        for (int t = 0; t < trees.length; t++) {
          Object[] own = (Object[]) trees[t];
          add(cells, total, size, (short[]) own[0], (byte[]) own[1], (int[]) own[2], (double[]) own[3], sums);
        }
      }
      return true;
    }

    public Object next() {
      if (!hasNext()) throw new java.util.NoSuchElementException();
      Row row = held[at];
      Object[] out = new Object[row.length()];
      for (int i = 0; i + 1 < out.length; i++) out[i] = row.get(i);
      out[out.length - 1] = Double.valueOf(sums[at]);
      held[at++] = null;
      return RowFactory.create(out);
    }

    public void remove() {
      throw new UnsupportedOperationException();
    }
  }

  /* (candidate, held, label, score) of every row, from sums that come by candidate and part.  Rows with
     equal hash, flag and label are one. */
  static class Scores implements Iterator {
    final long[] hash;
    final byte[] labels, held;
    final double parts;
    final int[] bounds;
    final Iterator sums;
    Row ahead;
    int candidate, first, at = 0, to = 0;
    long trees;
    long[] totals;

    Scores(Object[] table, double parts, Iterator sums) {
      hash = (long[]) table[1];
      labels = (byte[]) table[2];
      held = (byte[]) table[3];
      this.parts = parts;
      this.sums = sums;
      bounds = bounds(hash);
    }

    public boolean hasNext() {
      while (at >= to) {
        if (ahead == null) {
          if (!sums.hasNext()) return false;
          ahead = (Row) sums.next();
        }
        candidate = ahead.getInt(0);
        long part = ahead.getLong(1);
        first = at = bounds[(int) part];
        to = bounds[(int) part + 1];
        totals = new long[to - first];
        trees = 0;
        while (ahead != null && ahead.getInt(0) == candidate && ahead.getLong(1) == part) {
          java.nio.LongBuffer own = java.nio.ByteBuffer.wrap((byte[]) ahead.get(3)).asLongBuffer();
          for (int i = 0; i < totals.length; i++) totals[i] += own.get(i);
          trees += (long) ahead.getDouble(2);
          ahead = sums.hasNext() ? (Row) sums.next() : null;
        }
      }
      return true;
    }

    public Object next() {
      if (!hasNext()) throw new java.util.NoSuchElementException();
      int i = at;
      long total = 0, many = 0;
      while (at < to && hash[at] == hash[i] && labels[at] == labels[i] && held[at] == held[i]) {
        total += totals[at - first];
        many += trees;
        at++;
      }
      double score = (double) total / (many * parts);
      return RowFactory.create(new Object[] {Integer.valueOf(candidate), Integer.valueOf(held[i]), Integer.valueOf(labels[i]), Double.valueOf(score)});
    }

    public void remove() {
      throw new UnsupportedOperationException();
    }
  }
}
"""
CLASS = "loanlens.kernel.Task"

_BLOCKS = "row binary, label binary, held binary, codes binary"
_GROWN = "candidate int, number long, extra double, bytes binary"
_SCORED = "candidate int, is_validation int, label int, score double"


@lru_cache
def _made(application: str, spark: SparkSession) -> JavaObject:
    """The compiled class, known to the executors."""
    jvm, context = spark._jvm, spark.sparkContext
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
    compiler.cook(SOURCE)
    folder = tempfile.mkdtemp(prefix="loanlens-kernel-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"kernel-{uuid.uuid4().hex}.jar")
    with zipfile.ZipFile(path, "w") as jar:
        for name, code in dict(compiler.getBytecodes()).items():
            jar.writestr(name.replace(".", "/") + ".class", bytes(code))
    context._jsc.sc().addJar(path)
    return compiler.getClassLoader().loadClass(CLASS)


def _task(spark: SparkSession) -> JavaObject:
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    made = _made(spark.sparkContext.applicationId, spark)
    none = gateway.new_array(jvm.java.lang.Object, 0)
    return made.getDeclaredConstructor(gateway.new_array(jvm.java.lang.Class, 0)).newInstance(none)


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows as bytes."""
    for batch in batches:
        if batch.num_rows:
            held = [batch.column(c).to_numpy().astype(k) for c, k in (("row", "<i8"), ("label", "u1"), ("held", "u1"))]
            parts = [*(x.tobytes() for x in held), b"".join(batch.column("codes").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["row", "label", "held", "codes"])


def load(rows: DataFrame, n: int, bins: tuple[np.ndarray, np.ndarray]) -> JavaObject:
    """A broadcast of a table's ``n`` rows, in the order of their hashes."""
    spark = rows.sparkSession
    gateway = spark.sparkContext._gateway
    blocks = rows.sort("row", "held", "label").mapInArrow(_packed, _BLOCKS)
    sides = []
    for values in bins:
        array = gateway.new_array(spark._jvm.double, len(values))
        for i in np.flatnonzero(values).tolist():
            array[i] = float(values[i])
        sides.append(array)
    table = _task(spark).load(blocks._jdf.toLocalIterator(), n, len(bins[0]) // 256, *sides)
    return spark.sparkContext._jsc.broadcast(table)


def _mapped(df: DataFrame, table: JavaObject, mode: str, work: Sequence[str], schema: str) -> DataFrame:
    spark = df.sparkSession
    kind = spark._jvm.org.apache.spark.sql.types.StructType.fromDDL(schema)
    task = getattr(_task(spark), "with")(table, mode, "\n".join(work))
    rows = df._jdf.toDF().mapPartitions(task, spark._jvm.org.apache.spark.sql.Encoders.row(kind))
    return DataFrame(rows.toDF(), spark)


def grown(spark: SparkSession, table: JavaObject, work: Sequence[str], keep: bool) -> DataFrame:
    """(candidate, number, extra, bytes): each tree with its start value, or without ``keep`` the parts of the
    trees' summed values of all rows with the number of trees.  A task each."""
    ids = spark.range(0, len(work), 1, len(work))
    return _mapped(ids, table, "trees" if keep else "sums", work, _GROWN)


def scores(sums: DataFrame, table: JavaObject, parts: float) -> DataFrame:
    """(candidate, is_validation, label, score) of every row from its sums."""
    width = int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sums.repartition(width, "candidate", "number").sortWithinPartitions("candidate", "number")
    return _mapped(dealt, table, "scores", [repr(parts)], _SCORED)


def slice_of(trees: DataFrame) -> JavaObject:
    """A broadcast of some packed trees (tree, packed), in the order of their numbers."""
    spark = trees.sparkSession
    return spark.sparkContext._jsc.broadcast(_task(spark).unpack(trees._jdf.toLocalIterator()))


def values(coded: DataFrame, slices: Sequence[JavaObject], n_features: int, name: str) -> DataFrame:
    """Rows with the sum of their trees' values as ``name`` in place of their codes, the last column."""
    spark = coded.sparkSession
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.spark.broadcast.Broadcast, len(slices))
    for i, s in enumerate(slices):
        array[i] = s
    schema = T.StructType([*coded.schema.fields[:-1], T.StructField(name, T.DoubleType())])
    kind = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    rows = coded._jdf.mapPartitions(_task(spark).over(array, n_features), spark._jvm.org.apache.spark.sql.Encoders.row(kind))
    return DataFrame(rows, spark)
